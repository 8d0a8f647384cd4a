from lakemart.cli import main

main()
