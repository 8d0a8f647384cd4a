import random
import re
import time

import pytest

from lakemart.llm import license_scan as L

from .conftest import documents

BASE = {(b"mit", b"license"): "mit", (b"apache", b"license"): "apache", (b"general", b"public", b"license"): "gpl"}


def brute(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(words)) if tuple(words[i : i + len(phrase)]) == phrase]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def check(found, texts):
    for r, t in zip(found, texts, strict=True):
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t)
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_base_places_equal_brute_force(spark, sf001):
    rng = random.Random(5)
    parts = ["MIT", "license", "License,", "apache", "general", "public", "the", "\n", "lesser", "mit-license", "é"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    check(L.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect(), texts)
    docs = documents(spark, sf001)
    check(L.op8_license_scan(docs).collect(), [r["text"] for r in docs.collect()])


def test_odd_rows_and_empty_table(spark, odd_docs, odd_rows, no_docs):
    check(L.op8_license_scan(odd_docs).collect(), [r[1] for r in odd_rows])
    assert L.op8_license_scan(no_docs).count() == 0


@pytest.mark.parametrize(
    ("text", "alternatives"),
    [
        ("MIT", [["MIT"]]),
        ("MIT OR Apache-2.0", [["MIT"], ["Apache-2.0"]]),
        ("MIT AND BSD-3-Clause OR ISC", [["MIT", "BSD-3-Clause"], ["ISC"]]),
        ("MIT and (BSD-3-Clause or ISC)", [["MIT", "BSD-3-Clause"], ["MIT", "ISC"]]),
        ("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", [["GPL-2.0-only with Classpath-exception-2.0"], ["MIT"]]),
        ("MIT OR", [["MIT"]]),
        ("((MIT)", []),
        ("OR", []),
        ("", []),
        ("MIT is the one", [["MIT"]]),
    ],
)
def test_expressions(text, alternatives):
    assert L.evaluate(text) == frozenset(map(frozenset, alternatives))


def test_many_alternatives_stay_bounded():
    text = " and ".join(f"(a{i} or b{i})" for i in range(40))
    assert len(L.evaluate(text)) <= L.MOST_ALTERNATIVES


def test_tags_and_notices():
    s = L.Scanner().scan(b"# SPDX-License-Identifier: (MIT OR LGPL-3.0-or-later)\nx = 1\n")
    assert s.labels == {"mit", "lgpl"} and s.score == 1.0
    assert L.Scanner().scan(b"under the GNU Lesser General Public License").labels == {"gpl", "lgpl"}
    assert L.Scanner().scan(b"Licensed under CC BY-NC 4.0.").labels == {"cc-by", "cc-by-nc"}


def holds(alternatives, names):
    """Whether having the licences ``names`` satisfies the expression."""
    one = lambda x: x in names if isinstance(x, str) else all(holds(p, names) for p in x.parts)
    return any(all(map(one, a)) for a in alternatives)


def test_many_alternatives_keep_their_meaning():
    text = " and ".join(f"(a{i} or b{i})" for i in range(7))
    found = L.evaluate(text)
    for bits in range(1 << 7):
        names = {f"{'ab'[bits >> i & 1]}{i}" for i in range(7)}
        assert holds(found, names) and not any(holds(found, names - {x}) for x in names)
    shown = L._show(found)
    assert L.evaluate(shown) == found and " or " in shown
    mixed = L.evaluate(f"{text} or MIT")
    assert holds(mixed, {"MIT"}) and holds(mixed, {f"a{i}" for i in range(7)}) and not holds(mixed, {"a0", "b1"})
    assert L.evaluate(L._show(mixed)) == mixed
    both = L.evaluate(f"({text}) and (({text}) or MIT)")
    assert holds(both, {f"b{i}" for i in range(7)}) and not holds(both, {"MIT"})


def test_a_large_with_keeps_its_exceptions():
    many = " or ".join(f"a{i}" for i in range(70))
    assert L.evaluate(f"({many}) with x") == frozenset(frozenset([f"a{i} with x"]) for i in range(70))
    text = " and ".join(f"(a{i} or b{i})" for i in range(7))
    assert holds(L.evaluate(f"({text}) with x"), {f"a{i} with x" for i in range(7)})
    many_labels = L.Scanner().scan(f"SPDX-License-Identifier: {text} and (MIT or BSD-3-Clause)".encode()).labels
    assert many_labels == {"mit", "bsd"}


def test_a_long_factored_expression_stays_short():
    text = " and ".join(f"(a{i} or b{i})" for i in range(200))
    found = L.evaluate(text)
    assert len(L._show(found)) < 2 * len(text)
    assert holds(found, {f"a{i}" for i in range(200)}) and not holds(found, {f"a{i}" for i in range(199)})


def test_time_is_linear_in_the_text():
    scanner = L.Scanner()
    many = b"mit license " * 420_000  # 5 MB
    began = time.time()
    s = scanner.scan(many)
    assert (s.n_words, len(s.base), s.base[0][0], s.base[-1][0]) == (840_000, 420_000, 0, 839_998)
    odd = [b"(" * 1_000_000, b"a or " * 200_000 + b"b", b"a and " * 200_000 + b"b", b"a with " * 150_000 + b"b", b"(a or " * 150_000, b"a b " * 200_000]
    for text in odd:
        scanner.scan(b"SPDX-License-Identifier: " + text)
    scanner.scan(b"SPDX-License-Identifier:" * 200_000)
    scanner.scan(b"SPDX-License-Identifier: MIT or " * 150_000)
    assert time.time() - began < 30


def test_word_places_equal_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        words = [rng.choice(["mit", "license", "apache", "general", "public", "x"]) for _ in range(rng.randint(0, 40))]
        want = sorted((i, label) for phrase, label in L.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
        assert sorted(L.Scanner().scan(" ".join(words).encode()).base) == want


def test_the_longest_expression_equals_trying_every_prefix():
    rng = random.Random(9)
    for _ in range(3000):
        tokens = [rng.choice(["a", "b", "or", "AND", "with", "(", ")", "(", ")"]) for _ in range(rng.randint(0, 10))]
        best = []
        for n in range(len(tokens), 0, -1):
            try:
                L.to_postfix(tokens[:n])
            except L.ExpressionError:
                continue
            best = tokens[:n]
            break
        assert L.longest_expression(tokens) == best


def test_a_very_long_expression_keeps_its_identifiers():
    names = [f"x{i}" for i in range(L.MOST_TOKENS)]
    s = L.Scanner().scan(("License-Expression: MIT or " + " or ".join(names) + " and GPL-2.0-only").encode())
    assert s.labels == {"mit", "gpl"} and s.score == 1.0
    (found,) = s.expressions
    assert L._show(found).startswith("MIT or x0 or x1") and L._show(found).endswith("and GPL-2.0-only")


def expanded(item):
    """All alternatives of an identifier or a factored expression, without factors."""
    if isinstance(item, str):
        return {frozenset([item])}
    exceptions = "".join(getattr(item, "exceptions", ()))
    held = {frozenset()}
    for part in item.parts:
        held = {h | x for h in held for x in all_expanded(part)}
    return {frozenset(x + exceptions for x in a) for a in held}


def all_expanded(alternatives):
    out = set()
    for a in alternatives:
        held = {frozenset()}
        for item in a:
            held = {h | x for h in held for x in expanded(item)}
        out |= held
    return out


@pytest.mark.parametrize("most", [0, 3, 8, 40])
def test_long_expressions_have_the_alternatives_of_short_ones(monkeypatch, most):
    rng = random.Random(most)

    def some(depth):
        if not depth or rng.random() < 0.2:
            return rng.choice("abcdef")
        op = rng.choice(["or", "and", "with"])
        return f"({some(depth - 1)}) {op} {rng.choice('xyz') if op == 'with' else '(' + some(depth - 1) + ')'}"

    texts = [some(rng.randint(1, 4)) for _ in range(300)]
    monkeypatch.setattr(L, "MOST_ALTERNATIVES", 1 << 20)
    plain = [L.evaluate(t) for t in texts]
    monkeypatch.setattr(L, "MOST_TOKENS", most)
    for many in (2, 6, 64):
        monkeypatch.setattr(L, "MOST_ALTERNATIVES", many)
        for text, want in zip(texts, plain):
            found = L.evaluate(text)
            assert all_expanded(found) == want
            assert {x.split()[0] for a in found for x in L._names(a)} == {x.split()[0] for a in want for x in a}
            monkeypatch.setattr(L, "MOST_TOKENS", 4096)
            monkeypatch.setattr(L, "MOST_ALTERNATIVES", 1 << 20)
            assert L.evaluate(L._show(found)) == want
            monkeypatch.setattr(L, "MOST_TOKENS", most)
            monkeypatch.setattr(L, "MOST_ALTERNATIVES", many)


def test_a_very_long_expression_is_evaluated():
    n = L.MOST_TOKENS
    found = L.evaluate(" or ".join(f"(x{i} AND y{i} with z)" for i in range(n)))
    assert found == frozenset(frozenset([f"x{i}", f"y{i} with z"]) for i in range(n))
    assert L._show(found).startswith("x0 and y0 with z or x1 and y1 with z or ")
    assert L.evaluate(" and ".join(f"x{i}" for i in range(n))) == frozenset([frozenset(f"x{i}" for i in range(n))])
    many = L.evaluate(" and ".join(f"(a{i} or b{i})" for i in range(n)))
    assert holds(many, {f"{'ab'[i % 2]}{i}" for i in range(n)}) and not holds(many, {f"a{i}" for i in range(1, n)})
    s = L.Scanner().scan(("License-Expression: MIT with Apache-2.0 or " + " or ".join(["x"] * n)).encode())
    assert s.expressions == [frozenset(map(frozenset, [["MIT with Apache-2.0"], ["x"]]))] and s.labels == {"mit"}


def test_time_of_a_very_long_expression_is_linear():
    n = 20_000
    names = [f"x{i}" for i in range(n)]
    nested = lambda *ops: "".join(f"({x} {ops[i % len(ops)]} " for i, x in enumerate(names)) + "y" + ")" * n
    texts = [f" {op} ".join(names) for op in ("or", "and", "with")]
    texts += [nested("or"), nested("and"), nested("with"), nested("or", "and"), nested("with", "and"), nested("with", "or", "and")]
    texts += ["(" * n + "y" + "".join(f" {op} {x})" for x, op in zip(names, ops * n)) for ops in (["or", "and"], ["or", "with"], ["and", "with"])]
    texts += [" and ".join(f"({a} or {a}b)" for a in names), "(a or b) and " + " and ".join(names), "(a or b) with " + " with ".join(names)]
    began = time.time()
    for text in texts:
        found = L.evaluate(text)
        assert found and len(L._show(found)) < 5 * len(text)
        assert L.Scanner().scan(f"SPDX-License-Identifier: {text}".encode()).score == 1.0
    assert time.time() - began < 60


def test_labels_equal_a_plain_scan(spark, sf001):
    """Labels and score by a second, plain implementation: phrases as word lists, expressions by prefix trials."""

    def plain(text):
        text = text or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = []
        for phrase, label in (L.BASE_PHRASES | L.NOTICE_PHRASES).items():
            p = phrase.split()
            found += [label] * sum(words[i : i + len(p)] == p for i in range(len(words) - len(p) + 1))
        tagged = set()
        for m in re.finditer("|".join(map(re.escape, L.TAGS)), low):
            rest = re.split("\n|" + "|".join(map(re.escape, L.TAGS)), low[m.end() :])[0]
            tokens = re.findall(r"[()]|[A-Za-z0-9.+:_-]+", rest)
            for n in range(len(tokens), 0, -1):
                try:
                    tagged |= {t for t in L.to_postfix(tokens[:n]) if t not in L.PRECEDENCE}
                    break
                except L.ExpressionError:
                    continue
        labels = set(found) | {f for t in tagged if (f := L.family(t))}
        return ",".join(sorted(labels)), 1.0 if tagged else 1.0 - 0.5 ** len(found)

    docs = documents(spark, sf001)
    extra = spark.createDataFrame(
        [(-1, "SPDX-License-Identifier: (MIT or GPL-2.0) and\nx", None, None, 0), (-2, "license-expression: package-license: ISC with x", None, None, 0)], docs.schema
    )
    docs = docs.unionByName(extra)
    want = {r["doc_id"]: plain(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in L.op8_license_scan(docs).collect()} == want
