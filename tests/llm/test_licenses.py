import re

import pytest

from staylens.llm import licenses
from tests.llm.fixtures import answers, by_key, documents, frame

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
EXTRA = [
    "Licensed under the Apache License, Version 2.0 (the License)", "MIT License\nCC BY cc by cc-by-sa 4.0", "the GNU\nGeneral; Public License, version 3 and the GNU Lesser General Public License",
    "SPDX-License-Identifier: BSD-3-Clause", "mit licenses and mit-license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "https://www.gnu.org/licenses/gpl-3.0.html", "placed in the public domain", "ªMIT License", "cc by by cc by",
]


def rows():
    own = documents()
    return own + [(1000 + i, t, "en", "s", len(t)) for i, t in enumerate(EXTRA)] + [(2000, "pad " * 20000 + "mit license", "en", "s", 1)]


def base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_matches_brute_force(spark):
    got = answers(licenses.license_scan(frame(spark, rows(), clash=True)), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == by_key([(r[0], *base(r[1])) for r in rows()])


def test_gates_lose_no_detection():
    for r in rows():
        lowered = (r[1] or "").lower()
        assert licenses.detect(lowered) == licenses.detect(lowered, every_rule=True)


def test_rules_are_many_and_gated():
    rules = licenses.rules()
    assert len(rules) > 300
    for rule in rules:
        re.compile(rule.pattern)
        assert 0 < rule.confidence <= 1 and rule.gate == rule.gate.lower()


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0", "apache,apache-2.0"), ("GNU Lesser General Public License", "lgpl"), ("SPDX-License-Identifier: MIT", "mit"),
    ("see https://creativecommons.org/licenses/by-nc/4.0/", "cc-by-nc"), ("released under the 3-clause BSD license", "bsd-3-clause"), ("a smith licensed driver", ""), (None, ""), ("", "")])
def test_labels(spark, text, labels):
    r = licenses.license_scan(frame(spark, [(1, text, None, None, None)])).collect()[0]
    assert r["labels"] == labels and (r["score"] > 0) == bool(labels)
    assert all(0 <= d["start"] < d["end"] <= len(text) for d in r["detections"])


def test_containment():
    kept = licenses.detect("the gnu lesser general public license, version 2.1, or the mit license")
    rules = licenses.rules()
    assert [rules[r].label for _, _, r in kept] == ["lgpl-2.1", "mit"]
    assert all(not (a[0] >= b[0] and a[1] <= b[1]) for a in kept for b in kept if a is not b)


def test_empty_table(spark):
    assert licenses.license_scan(frame(spark, [])).count() == 0


WRAPPED = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated", "mit"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted", "bsd"),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as", "gpl"),
    ("the GNU Lesser General Public\n\tLicense", "lgpl"), ("the GNU General Public  \r\n  License, version 3", "gpl-3.0"), ("the Common\nDevelopment and Distribution License", "cddl-1.0"),
]


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", ";; ", "-- ", "box"])
@pytest.mark.parametrize("text, label", WRAPPED)
def test_wrapped_and_commented_lines(text, label, mark):
    text = "\n".join(f" *  {x}   *" for x in text.split("\n")) if mark == "box" else mark + re.sub(r"(\r?\n)", rf"\1{mark}", text)
    lowered = text.lower()
    kept = licenses.detect(lowered)
    assert label in {licenses.rules()[r].label for _, _, r in kept}
    for a, b, r in kept:  # spans are places of the text itself
        span = lowered[a:b]
        assert span == span.strip(" *#/\n") and re.fullmatch(licenses.rules()[r].pattern, licenses.fold(span)[0])


def test_folding_keeps_places():
    for r in rows():
        text = r[1] or ""
        folded, at, origin = licenses.fold(text)
        ends = [*at[1:], len(folded)]
        assert "\n" not in folded and "  " not in folded
        for a, b, o in zip(at, ends, origin):
            assert folded[a:b] == text[o : o + b - a] or folded[a:b] == " "


def contained(lowered):
    """The accepted detections, each held against every one accepted before."""
    order, kept = licenses.rules(), []
    folded, at, origin = licenses.fold(lowered)
    place = lambda x: origin[k := licenses.bisect_right(at, x) - 1] + x - at[k]
    found = [(place(m.start()), place(m.end() - 1) + 1, i) for i, r in enumerate(order) for m in re.finditer(r.pattern, folded)]
    for d in sorted(found, key=lambda d: (-order[d[2]].priority, d[0] - d[1], d[0], d[2])):
        if not any(a <= d[0] and d[1] <= b for a, b, _ in kept):
            kept.append(d)
    return sorted(kept)


def test_containment_matches_brute_force():
    texts = [r[1] or "" for r in rows()[:-1]] + [" ".join(EXTRA * 4), "mit license, licensed under the mit license, " * 40]
    for t in texts:
        assert licenses.detect(t.lower()) == contained(t.lower())


def test_many_detections_in_one_long_text():
    n = 200_000
    found = licenses.detect("mit license,\n" * n)  # 2.6 MB
    assert len(found) == n and len({d[2] for d in found}) == 1
