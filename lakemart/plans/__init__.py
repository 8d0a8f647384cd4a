"""Layer builders (silver, gold), reports, and the whole run."""
