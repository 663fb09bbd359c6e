"""License scans: the gate and the suppression against plain matching, and the contract's counts."""

import random
import re
from re import _constants as sre
from re import _parser as parser

import pytest
from pyspark.sql import functions as F

from courtline.llm import licenses
from courtline.llm.license_rules import RULES
from courtline.llm.licenses import PHRASES, gate, normal, scan, scan_text, summary, suppress
from courtline.llm.queries import QUERIES


def example(parsed, rng):
    """A text that the parsed pattern matches."""
    out = []
    for op, arg in parsed:
        if op is sre.LITERAL:
            out.append(chr(arg))
        elif op is sre.NOT_LITERAL or op is sre.ANY:
            out.append("w")
        elif op is sre.IN:
            (kind, value), *_ = rng.sample(list(arg), 1)
            out.append("w" if arg[0][0] is sre.NEGATE else "7" if kind is sre.CATEGORY else chr(value[0] if kind is sre.RANGE else value))
        elif op is sre.BRANCH:
            out.append(example(rng.choice(arg[1]), rng))
        elif op is sre.SUBPATTERN:
            out.append(example(arg[3], rng))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            out += [example(inner, rng) for _ in range(rng.randint(low, min(high, low + 2)))]
        elif op not in (sre.ASSERT, sre.ASSERT_NOT):
            raise NotImplementedError(op)
    return "".join(out)


@pytest.fixture(scope="module")
def examples():
    rng = random.Random(3)
    return [(k, re.sub(" +", " ", example(parser.parse(rule.pattern.pattern), rng)).strip()) for k, rule in enumerate(RULES) for _ in range(4)]


def brute(words):
    """All rules, matched without a gate; each place against each."""
    places = [(m.start(), m.end(), k) for k, rule in enumerate(RULES) for m in rule.pattern.finditer(words)]
    order = sorted(places, key=lambda p: (RULES[p[2]].priority, p[0] - p[1], p[2], p[0]))
    kept = []
    for place in order:
        if not any(k[0] <= place[0] and place[1] <= k[1] for k in kept):
            kept.append(place)
    return sorted(kept)


def test_hundreds_of_rules_each_with_a_keyword_in_every_match(examples):
    assert len(RULES) > 500
    for number, text in examples:
        found = [m.group() for m in RULES[number].pattern.finditer(text)]
        assert found and all(RULES[number].keyword in m for m in found), (RULES[number], text)


def test_gate_and_suppression_lose_nothing(examples):
    rng, automaton = random.Random(5), gate(RULES)
    texts = [t for _, t in examples]
    for _ in range(150):
        words = normal(" ".join(x for t in rng.sample(texts, 5) for x in (t, rng.choice(["", "and", "the words of a text"]))))
        kept = [(m[0], m[1], m[2]) for m in suppress(licenses.places_of(words, automaton))]
        assert kept == brute(words)


SAID = {
    "This work is licensed under the GNU General Public License, version 3.": ("gpl", "gpl,gpl-3.0"),
    "Licensed under CC BY-NC 4.0": ("cc-by", "cc-by,cc-by-nc-4.0"),
    "released under the MIT license": ("mit", "mit"),
    "Licensed under the Apache License, Version 2.0": ("apache", "apache,apache-2.0"),
    "GNU Lesser General Public License (version 2.1 or any later version)": ("", "lgpl-2.1-or-later"),
    "SPDX-License-Identifier: BSD-3-Clause": ("", "bsd-3-clause"),
    "Creative Commons Attribution-ShareAlike 4.0 licence": ("", "cc-by-sa-4.0"),
    "Permission is hereby granted, free of charge, to any person obtaining a copy": ("", "mit"),
    "https://www.apache.org/licenses/LICENSE-2.0": ("", "apache-2.0"),
    "The committee met under the bridge and gave a license to nobody.": ("", ""),
    "mitlicense, mit-license and MIT LICENSE; İMIT license": ("mit", "mit"),
}


def contract(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    found = [(k, label) for k in range(len(words)) for p, label in PHRASES.items() if words[k : k + len(p.split())] == p.split()]
    at = [k for k, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))


def test_texts_and_their_labels(spark):
    docs = spark.createDataFrame(list(enumerate(SAID)), "doc_id long, text string")
    for row in summary(scan(docs)).collect():
        assert (row.base_labels, row.labels) == SAID[row.text]
        assert contract(row.text) == (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels)
        assert (row.score > 0.5) == bool(row.labels) and row.score <= 1
        for x in row.found:
            assert 0 <= x["first"] <= x["last"] < row.n_words


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op12_license_scan"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert contract(texts[r.doc_id]) == (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        told = [RULES[k].label for _, _, k in brute(normal(texts[r.doc_id]))] if re.search("licen|rights|domain|cc|bsd|gpl", (texts[r.doc_id] or "").lower()) else []
        assert r.labels == ",".join(sorted({*told, *filter(None, r.base_labels.split(","))}))
        assert (r.score > 0) == bool(r.labels)
    assert 0 < sum(bool(r.labels) for r in rows) < 0.1 * len(rows)


def test_odd_rows(spark, odd, none):
    docs = odd.withColumns({"base": F.lit("clash"), "n_base": F.lit("clash")})
    rows = summary(scan(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert contract(r.text) == (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) and r.score == 0 and r.labels == ""
    assert summary(scan(none)).count() == 0
    long = "some words " * 300_000 + "MIT License " * 20_000
    n_words, base, found = scan_text(long, gate(RULES))
    assert (n_words, len(base), len(found)) == (640_000, 20_000, 20_000) and base[0][0] == 600_000
