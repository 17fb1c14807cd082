import random
import re

from supplylake.llm.license_rules import RULES, Rule, parsed
from supplylake.llm.license_scan import BASE, BELIEF, scan_licenses

from .cases import LONG, awkward, empty, prose

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def kept_by_order(found):
    """The rules' own words: best level first, one match after the other."""
    kept = []
    for level in sorted({f[2] for f in found}):
        better, own = list(kept), []
        for f in sorted((f for f in found if f[2] == level), key=lambda f: (f[0], -f[1], f[3])):
            if any((b[0] <= f[0] and f[1] <= b[1]) or (f[0] <= b[0] and b[1] <= f[1]) for b in better):
                continue
            if not any(o[0] <= f[0] and f[1] <= o[1] for o in own):
                own.append(f)
        kept += own
    return sorted(kept)


def brute(text, rules=RULES, phrases=BASE):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    places = [(i, label) for phrase, label in phrases.items() for k in [phrase.split()]
              for i in range(len(words)) if words[i:i + len(k)] == k]
    line = " " + " ".join(words) + " "
    found = [(line[:m.start()].count(" ") - 1, line[:m.end()].count(" ") - 1, r.priority, r.rule, r.label)
             for r in rules if r.keyword in words for m in re.finditer(r.pattern, line)]
    kept = kept_by_order(found)
    base = sorted({label for _, label in places})
    score = max([BELIEF[2]] * bool(places) + [BELIEF[f[2]] for f in kept] + [0.0])
    return (len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(base),
            ",".join(sorted({*base, *(f[4] for f in kept)})), score, [(f[0], f[1], f[4], f[2], f[3]) for f in kept])


def check(spark, docs, rules=None, phrases=None):
    got = sorted(([r[0], *r[1:8], [tuple(d) for d in r.detections]] for r in scan_licenses(docs, rules, phrases).collect()), key=str)
    want = sorted(([r.doc_id, *brute(r.text, RULES if rules is None else rules, BASE if phrases is None else phrases)]
                   for r in docs.select("doc_id", "text").collect()), key=str)
    assert got == want
    return got


NOTICES = ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: GPL-3.0-or-later", "Released under the MIT License.",
           "GNU Lesser General Public License v2.1 or any later version", "CC BY-NC-SA 4.0", "CC BY cc by CC-BY 4.0",
           "licensed under the new BSD license", "This is free and unencumbered software released into the public domain.",
           "GNU  General\nPublic License, version 3", "the Frobnicate Public License", "licensed under the terms of the Frob license",
           "https://creativecommons.org/licenses/by-sa/3.0/", "Mozilla Public License 2.0", "apache license apache license",
           "Redistribution and use in source and binary forms, with or without modification, are permitted", "CC0 1.0 Universal"]


def test_against_brute_force(spark):
    rng = random.Random(2)
    texts = []
    for i in range(150):
        parts = [prose(i * 7 + k, rng.randint(0, 30)) for k in range(4)]
        parts += rng.choices(NOTICES, k=rng.randint(0, 4)) + rng.choices(["license", "gnu", "cc", "mit", "public", "apache 2"], k=2)
        rng.shuffle(parts)
        texts.append(rng.choice([" ", ", ", "\n", "... "]).join(parts))
    got = check(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sum(bool(r[6]) for r in got) > 80 and sum(not r[6] for r in got) > 5


def test_each_notice_has_its_label(spark):
    named = dict(zip(range(len(NOTICES)), NOTICES))
    got = {r.doc_id: r.labels for r in scan_licenses(spark.createDataFrame(list(named.items()), "doc_id long, text string")).collect()}
    want = ["apache,apache-2.0", "gpl-3.0+", "mit", "lgpl-2.1+", "cc-by,cc-by-nc-sa-4.0", "cc-by,cc-by-4.0", "bsd-3-clause", "unlicense", "gpl,gpl-3.0",
            "", "unknown", "cc-by-sa", "mpl-2.0", "apache", "bsd", "cc0-1.0"]
    assert [got[i] for i in named] == want


def test_suppression_by_level_and_containment(spark):
    rules = [Rule(0, "wide", 2, "a", "(?<= )a(?: \\w+){4} f(?= )"), Rule(1, "inner", 2, "a", "(?<= )b c(?= )"),
             Rule(2, "best", 1, "a", "(?<= )c d(?= )"), Rule(3, "late", 3, "a", "(?<= )f g(?= )"), Rule(4, "twin", 3, "a", "(?<= )f g(?= )"),
             Rule(5, "x", 2, "a", "(?<= )x(?: x)?(?= )")]
    texts = ["a b c d e f g", "a b c q e f g", "a x x x f g", "b c", "a " + "x " * 500 + "b c d", ""]
    check(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), rules, {"b c": "bc", "x x": "xx"})
    check(spark, spark.createDataFrame([(0, "mit license")], "doc_id long, text string"), [], {"a a": "aa"})


def test_awkward_rows(spark):
    check(spark, awkward(spark))
    rows = [(1, "MIT License"), (1, "MIT License"), (None, "gpl 2.0 only Kn"), (2, None), (3, LONG + " Apache License 2.0 " + LONG),
            (4, "İ MİT license mit licensé, ÄPACHE"), (5, "mit license " * 3000)]
    check(spark, spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, labels string, row int").repartition(3))
    assert scan_licenses(empty(spark)).count() == 0


def test_rules_are_hundreds_and_gated_by_a_word_of_theirs():
    assert len(RULES) > 200 and [r.rule for r in RULES] == list(range(len(RULES)))
    assert len(parsed("a | 1 | k | k<2.1><+>\n# no rule\n")) == 1
    loose = [r for r in RULES if r.keyword not in r.pattern and not {"gplv", "mplv", "agplv"} & {r.keyword}]
    assert loose == []
