from __future__ import annotations

import difflib
import itertools
import math
import random
import textwrap
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses, toxicity, warc
from tidemark.llm.catalogue import CATALOGUE


def best_segments(scores):
    """All maximal scoring segments by their definition: the best segment, then the same to its left and right."""

    def inside(a, b):
        spans = [(sum(scores[i:j]), i, j) for i, j in itertools.combinations(range(a, b + 1), 2)]
        if not spans or (best := max(spans, key=lambda s: (round(s[0], 6), s[1] - s[2])))[0] <= 0:
            return []
        return [*inside(a, best[1]), (best[1], best[2], round(best[0], 6)), *inside(best[2], b)]

    return inside(0, len(scores))


def test_segments_are_the_maximal_ones():
    rng = random.Random(2)
    for _ in range(200):
        scores = [rng.choice([-3.0, -1.3, -0.6, 0.7, 1.1, 2.9]) + rng.random() / 7 for _ in range(rng.randrange(14))]
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(np.array(scores))]
        assert got == best_segments(scores)


def test_segments_of_sinking_scores_take_linear_time():
    n = 60_000
    scores = np.tile([1.0, -1.5], n)
    began = time.process_time()
    assert toxicity.segments(scores) == [(2 * i, 2 * i + 1, 1.0) for i in range(n)]
    assert time.process_time() - began < 20


def test_passages_of_texts_whose_lower_case_is_longer():
    model = toxicity.Model({"vile": 5.0, "i\u0307gre*": 4.0}, 2.0)
    scores = toxicity._Scores(model)
    text = "İstanbul İİ and so on, VILE vile \u0130GREN\u00c7 ends"
    n, found = toxicity._scan(text, scores)
    spans = toxicity._spans(text, [(a, b, s, 0.0) for a, b, s in found])
    assert n == 9 and [text[x["start"] : x["end"]] for x in spans] == ["VILE vile \u0130GREN\u00c7"]


@pytest.fixture(scope="module")
def scored(spark):
    return CATALOGUE["op1_toxicity"](spark, "/root/testdata/sf0.01").toPandas()


def test_toxicity_on_rows_that_were_held_out(spark, scored):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert len(scored) == documents.count() and scored["score"].between(0, 1).all()
    assert (scored["predicted"] == (scored["score"] >= 0.5)).all()
    assert scored["held_out"].tolist() == [toxicity.fold(d) == 0 for d in scored["doc_id"]]
    both = scored.merge(labels, on="doc_id")
    out = both[both["held_out"]]
    toxic, clean = (out[out["toxic"] == k]["score"].to_numpy() for k in (1, 0))
    assert (toxic[:, None] > clean[None, :]).mean() > 0.9
    assert (out["predicted"] == out["toxic"]).mean() > 0.93


def plain_scores(documents, labels):
    """The scores of all documents by a fit in plain Python: sums of counts, best sums of neighbours, Newton's steps."""
    found = {d: toxicity._WORD.findall(t or "") for d, t in documents}
    known = {d: y for d, y in labels if zlib.crc32(str(d).encode()) % 5}
    corpus, of = Counter(), {0: Counter(), 1: Counter()}
    for d, words in found.items():
        for word in {w.lower() for w in words}:
            for term in (word, *(word[:n] + "*" for n in toxicity.STEMS if len(word) > n)):
                corpus[term] += 1
                if d in known:
                    of[known[d]][term] += 1
    whole = {k: sum(n for t, n in c.items() if not t.endswith("*")) for k, c in ((0, of[0]), (1, of[1]), (2, corpus))}
    prior = toxicity.PRIOR * (whole[0] + whole[1])
    odds, share = {}, {}
    for term, n in of[1].items():
        drawn = prior * corpus[term] / whole[2]
        a, b = n + drawn, of[0][term] + drawn
        value = math.log(a / (whole[1] + prior - a)) - math.log(b / (whole[0] + prior - b))
        if value >= toxicity.MIN_ODDS and value / math.sqrt(1 / a + 1 / b) >= toxicity.MIN_Z:
            odds[term], share[term] = value, b / (whole[0] + prior)
    rest = 1 - sum(share.values())
    cost = max(toxicity.COST, 2 * sum(share[t] * odds[t] for t in odds) / rest)
    low, high = 1e-3, 50.0
    for _ in range(100):
        scale = (low + high) / 2
        mean = rest * math.exp(-cost * scale) + sum(share[t] * math.exp(scale * odds[t]) for t in odds)
        low, high = (scale, high) if mean < 1 else (low, scale)
    evidence = {}
    for d, words in found.items():
        best = now = 0.0
        for word in map(str.lower, words):
            fits = [t for t in (word, *(word[:n] + "*" for n in toxicity.STEMS if len(word) > n)) if t in odds]
            now = max(0.0, now + (odds[fits[0]] if fits else -cost))
            best = max(best, now)
        evidence[d] = low * best - math.log(len(words) + 1)
    rows = [(evidence[d], y) for d, y in known.items() if d in evidence]
    slope, level, ridge = 0.1, 0.0, 1e-3 * len(rows)
    for _ in range(200):
        p = [1 / (1 + math.exp(-max(-30, min(30, slope * x + level)))) for x, _ in rows]
        g = [sum((y - q) * x for (x, y), q in zip(rows, p)) - ridge * (slope - 0.1), sum(y - q for (_, y), q in zip(rows, p)) - ridge * level]
        h = [sum(q * (1 - q) * x**i for (x, _), q in zip(rows, p)) for i in (2, 1, 0)]
        det = (h[0] + ridge) * (h[2] + ridge) - h[1] ** 2
        step = ((h[2] + ridge) * g[0] - h[1] * g[1]) / det, ((h[0] + ridge) * g[1] - h[1] * g[0]) / det
        slope, level = slope + max(-1, min(1, step[0])), level + max(-1, min(1, step[1]))
    return {d: 1 / (1 + math.exp(-max(-700, min(700, max(slope, 1e-6) * x + level)))) for d, x in evidence.items()}


def test_scores_are_those_of_a_fit_in_plain_python(spark, scored):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").collect()]
    wanted = plain_scores(docs, [r for r in labels if r[1] is not None])
    assert len(wanted) == len(scored)
    for d, score in zip(scored["doc_id"], scored["score"]):
        assert abs(score - wanted[d]) < 1e-6


def test_an_id_with_very_many_rows_counts_once(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abdeimnorstuy", k=6)) for _ in range(300)]
    docs = [(i, " ".join(rng.choices(words, k=20) + ["grubstuff"] * (i % 9 == 0))) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i, _ in docs], "doc_id long, toxic int")
    once = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    many = docs + [(9, docs[9][1])] * 500 + [(10, f"{docs[10][1]} {i}") for i in range(500)]
    again = toxicity.fit(spark.createDataFrame(many, "doc_id long, text string"), labels)
    assert abs(again.probability(again.evidence(0, 21)) - once.probability(once.evidence(0, 21))) < 0.1
    assert toxicity.score(spark.createDataFrame(many, "doc_id long, text string"), again).count() == len(many)


def test_toxicity_without_labels_and_of_odd_documents(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd_documents[1], labels)
    rows = toxicity.score(odd_documents[1], model).collect()
    assert len(rows) == len(odd_documents[0]) and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in rows)
    assert toxicity.score(odd_documents[1].limit(0), model).count() == 0
    assert toxicity.fit(odd_documents[1].limit(0), labels.limit(0)).terms == {}


def test_passages_point_at_what_is_toxic(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abdeimnorstuy", k=6)) for _ in range(500)]
    docs = []
    for i in range(400):
        left, right = (" ".join(rng.choices(words, k=30)) for _ in range(2))
        docs.append((i, f"{left} Vile grubstuff, vile grubling {right}" if i % 10 == 0 else f"{left} {right}"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in docs], "doc_id long, toxic int")
    rows = toxicity.score(frame, toxicity.fit(frame, labels)).collect()
    assert all(r["predicted"] == (r["doc_id"] % 10 == 0) for r in rows)
    for r in rows:
        found = [docs[r["doc_id"]][1][p["start"] : p["end"]] for p in r["passages"]]
        assert found == (["Vile grubstuff, vile grubling"] if r["doc_id"] % 10 == 0 else [])


def test_a_sample_of_labels_keeps_the_mix_of_classes(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abdeimnorstuy", k=6)) for _ in range(300)]
    docs = []
    for i in range(2200):
        vile = rng.random() < (0.8 if i % 11 == 0 else 0.02)
        docs.append((i, " ".join(rng.choices(words, k=20) + ["grubstuff"] * vile)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 11 == 0)) for i, _ in docs], "doc_id long, toxic int")
    whole = toxicity.fit(frame, labels)
    monkeypatch.setattr(toxicity, "MAX_LABELS", 130)
    part = toxicity.fit(frame, labels)
    assert "grubstuff" in whole.terms and "grubstuff" in part.terms
    vile = [m.probability(m.evidence(m.terms["grubstuff"], 21)) for m in (whole, part)]
    clean = [m.probability(m.evidence(0, 21)) for m in (whole, part)]
    assert abs(vile[0] - vile[1]) < 0.2 and abs(clean[0] - clean[1]) < 0.05


def test_planted_license_lines_are_found_and_nothing_else(spark, sf_dir, documents):
    lines = {texts[0]: name for name, texts in licenses.TEMPLATES.items()}
    wanted = {d: ",".join(sorted({lines[x] for x in t.split("\n") if x in lines})) for d, t in documents[0]}
    rows = CATALOGUE["op8_license_scan"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["licenses"] for r in rows} == wanted
    assert any(wanted.values())


def scan_text(text):
    scanner = licenses.Scanner()
    return [[f["license"] for f in scanner.licenses(text[a:b])] for a, b in licenses.blocks(text)]


@pytest.mark.parametrize(("name", "text"), [(n, t) for n, texts in licenses.TEMPLATES.items() for t in texts])
def test_each_template_is_found_also_with_small_changes(name, text):
    words = text.split()
    assert name in scan_text(f"Some prose.\n{text}\nMore prose.")[0]
    scanner = licenses.Scanner()
    spans = [(f["start"], f["end"]) for f in scanner.licenses(f"Some prose. {text} More.") if f["license"] == name]
    assert [f"Some prose. {text} More."[a:b].rstrip(".:/") for a, b in spans] == [text.rstrip(".:/")]
    wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    assert any(name in found for found in scan_text(wrapped.upper()))
    if len(words) > 30:
        assert any(name in found for found in scan_text(" ".join([*words[:10], "kindly", *words[10:20], *words[21:]])))


def test_every_license_of_a_block_is_told():
    texts = licenses.TEMPLATES
    lines = [texts["GPL-3.0"][1], texts["Apache-2.0"][0], texts["MIT"][0]]
    assert sorted(scan_text("\n".join(lines))[0]) == ["Apache-2.0", "GPL-3.0", "MIT"]
    for order in (list(texts), list(texts)[::-1]):
        assert sorted(scan_text("\n".join(texts[name][-1] for name in order))[0]) == sorted(texts)
        assert sorted(scan_text("\n".join(texts[name][0] for name in order) * 2)[0]) == sorted(texts)


def test_a_wording_is_told_with_all_its_differences_and_hides_its_siblings():
    for text, name in ((t, n) for n, texts in licenses.TEMPLATES.items() for t in texts):
        assert scan_text(text) == [[name]]
    words = licenses.TEMPLATES["MIT"][1].split()
    block = " ".join(["Copyright"] * 5000 + [*words[:10], "kindly", *words[10:20], *words[21:]])
    found = licenses.Scanner().licenses(block)
    assert [(f["license"], f["lacking"], f["added"]) for f in found] == [("MIT", ["the"], ["kindly"])]
    assert block[found[0]["start"] : found[0]["end"]].split()[0] == "Permission"


BSD = """Copyright (c) 2001, The Authors. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
CREDIT = """3. All advertising materials mentioning features or use of this software must
   display the following acknowledgement: This product includes software
   developed by Some Lab.
"""
NAMES = """3. Neither the name of {} nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission.
"""
AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE."""


def test_bsd_licenses_are_told_by_their_clauses():
    lab = NAMES.format("Some Lab")
    for end in ("", AS_IS):
        assert scan_text(BSD + end) == [["BSD-2-Clause"]]
        assert scan_text(BSD + lab + end) == [["BSD-3-Clause"]]
        assert scan_text(BSD + CREDIT + lab + end) == [["BSD-4-Clause"]]
        # Too many names for the wording; not the license with fewer clauses.
        assert scan_text(BSD + NAMES.format("one " * 30) + end) == [["BSD"]]
        assert scan_text(BSD + "3. Do not endorse products by our name.\n" + end) == [["BSD"]]
    assert scan_text(BSD[: BSD.index("1.")]) == [["BSD"]]
    assert sorted(scan_text(BSD + BSD + lab)[0]) == ["BSD-2-Clause", "BSD-3-Clause"]


def test_a_clause_far_after_a_wording_tells_the_family():
    names = "3. names of the authors may not be used to endorse products.\n"
    assert scan_text(BSD + names) == [["BSD"]]
    assert scan_text(BSD + "more conditions and permission notices " * 40 + "\n" + names) == [["BSD"]]
    assert scan_text(BSD + "more conditions and permission notices " * 40) == [["BSD-2-Clause"]]
    other = licenses.TEMPLATES["MIT"][0]
    assert sorted(scan_text(f"{BSD}{other}\n{names}")[0]) == ["BSD-2-Clause", "MIT"]


def test_compression_decides_which_of_several_like_wordings_is_told(monkeypatch):
    """A text with three clauses holds the wordings of its siblings with fewer; in another order one of those is told."""
    text = licenses.TEMPLATES["BSD-3-Clause"][0]
    scanner = licenses.Scanner()
    assert [f["license"] for f in scanner.licenses(text)] == ["BSD-3-Clause"]
    ranked = scanner.reductions
    monkeypatch.setattr(scanner, "reductions", lambda have: [-x for x in ranked(have)])
    assert [f["license"] for f in scanner.licenses(text)] == ["BSD"]
    nothing = [0.0] * len(scanner.templates)
    monkeypatch.setattr(scanner, "reductions", lambda have: nothing)
    assert [f["license"] for f in scanner.licenses(text)] == ["BSD"]


def test_names_tell_licenses_of_one_family():
    for name in ("GPL-3.0", "AGPL-3.0", "GPL-2.0", "LGPL-2.1"):
        notice = licenses.TEMPLATES[name][1]
        for width in (5, 8, 60):
            lines = textwrap.wrap(notice, width * 5)
            assert scan_text("\n".join(["/*", *(f" * {x}" for x in lines), " */"])) == [[name]]


def generated_block(rng):
    """Wordings in any order with other words between them and small changes, and what has to be told of each."""
    names = rng.sample(list(licenses.TEMPLATES), rng.randrange(1, 7))
    lines, wanted = [], {}
    for name in names:
        text = rng.choice([t for t in licenses.TEMPLATES[name]])
        words, plain = text.split(), licenses.words(text)
        lacking, added = [], []
        # A word in the middle goes or comes, as far as a wording may differ.
        for _ in range(int((1 - licenses.MIN_SAME) * len(plain) + 1e-9) // 2):
            at = rng.randrange(2, len(words) - 2)
            if rng.random() < 0.5:
                words.insert(at, f"{rng.choice('qxz')}ord{rng.randrange(99)}q")
                added.append(licenses.words(words[at])[0])
            elif len(own := licenses.words(words[at])) == 1 and not licenses._tells(own[0]):
                lacking += licenses.words(words.pop(at))
        wanted[name] = lacking, added
        width = rng.randrange(4, 30)
        lines += [" ".join(words[i : i + width]) for i in range(0, len(words), width)]
        lines += ["Copyright " + " ".join(f"filler{rng.randrange(999)}" for _ in range(rng.randrange(9)))] * rng.randrange(3)
    return "\n".join(lines), wanted


@pytest.mark.parametrize("seed", range(12))
def test_generated_blocks_against_difflib(seed):
    scanner = licenses.Scanner()
    text, wanted = generated_block(random.Random(seed))
    found = {f["license"]: f for f in scanner.licenses(text)}
    family = {"BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"}
    assert set(found) - family == set(wanted) - family and bool(family & set(found)) == bool(family & set(wanted))
    for name in set(wanted) - family:
        one = found[name]
        have = licenses.words(text[one["start"] : one["end"]])
        best = min((licenses.words(t) for t in licenses.TEMPLATES[name]), key=lambda w: abs(len(w) - len(have)))
        steps = difflib.SequenceMatcher(None, best, have, autojunk=False).get_opcodes()
        lacking = sum(b - a for tag, a, b, _, _ in steps if tag in ("delete", "replace"))
        added = sum(b - a for tag, _, _, a, b in steps if tag in ("insert", "replace"))
        assert (len(one["lacking"]), len(one["added"])) <= (lacking, added)
        assert Counter(one["lacking"]) == Counter(wanted[name][0]) and Counter(one["added"]) == Counter(wanted[name][1])
        assert Counter(have) - Counter(one["added"]) == Counter(best) - Counter(one["lacking"])


def test_query_against_a_search_of_plain_lines(spark, sf_dir, documents):
    """Every line or neighbouring lines of a document whose words are a template's, by difflib; nothing else is told."""
    templates = [(name, licenses.words(t)) for name, texts in licenses.TEMPLATES.items() for t in texts]
    wanted = {}
    for doc, text in documents[0]:
        mine = set()
        if any(cue in (text or "").lower() for cue in licenses.CUES):
            have = licenses.words(text)
            for name, own in templates:
                match = difflib.SequenceMatcher(None, own, have, autojunk=False).find_longest_match()
                if match.size >= licenses.MIN_SAME * len(own):
                    mine.add(name)
        wanted[doc] = ",".join(sorted(mine))
    rows = CATALOGUE["op8_license_scan"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["licenses"] for r in rows} == wanted


def test_a_block_longer_than_what_is_compared_at_once():
    texts = [licenses.TEMPLATES[n][-1] for n in ("MIT", "Zlib", "GPL-2.0")]
    block = (" copyright" * 4090 + " ").join(["", *texts, ""])
    assert sorted(f["license"] for f in licenses.Scanner().licenses(block)) == ["GPL-2.0", "MIT", "Zlib"]


def test_spdx_tags_are_told_by_their_identifiers():
    for line, names in {
        "// SPDX-License-Identifier: MIT": ["MIT"],
        "/* spdx-license-identifier: (GPL-2.0-only OR bsd-3-clause) */": ["GPL-2.0", "BSD-3-Clause"],
        "# SPDX-License-Identifier: GPL-3.0-or-later WITH GCC-exception-3.1 AND Zlib": ["GPL-3.0", "Zlib"],
        "SPDX-License-Identifier: LGPL-3.0+.": ["LGPL-3.0"],
        "SPDX-License-Identifier: see the file": [],
        "SPDX-License-Identifier: NONE": [],
        "SPDX-License-Identifier:": [],
    }.items():
        assert scan_text(line) == [names], line
    found = licenses.Scanner().licenses("x\nSPDX-License-Identifier: MIT\n")
    assert [(f["start"], f["end"]) for f in found] == [(27, 30)]


def test_versions_and_other_prose_are_told_apart():
    assert scan_text("Licensed under the Apache License, Version 1.1.") == [[]]
    assert scan_text("This work is licensed under the GNU General Public License, version 2.") == [["GPL-2.0"]]
    assert scan_text("A driving licence is a permission, not a warrant.") == [[]]
    assert scan_text("Nothing here.") == [] and scan_text("") == []


def test_license_scan_of_odd_documents(odd_documents):
    rows = licenses.scan(odd_documents[1]).collect()
    assert len(rows) == len(odd_documents[0]) and all(r["found"] == [] for r in rows)
    assert licenses.scan(odd_documents[1].limit(0)).count() == 0


PAGES = "page_id long, url string, html string, file string"


def test_an_audit_finds_what_was_spoilt_and_nothing_else(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = {r["page_id"]: r for r in CATALOGUE["op9_warc_fixity"](spark, sf_dir).collect()}
    assert len(rows) == pages.count()
    luck = pages.select("page_id", F.pmod(F.xxhash64("page_id"), F.lit(500)).alias("x")).collect()
    luck = {r["page_id"]: r["x"] for r in luck}
    assert {i: r["status"] for i, r in rows.items()} == {i: {0: "changed", 1: "missing"}.get(x, "intact") for i, x in luck.items()}


@pytest.mark.parametrize("file_bytes", [1 << 30, 3000])
def test_changed_missing_extra_and_doubled_records(spark, tmp_path, file_bytes):
    rows = [(i, f"http://a/{i}", "x" * 400 * (i % 5), "clash") for i in range(60)] + [(7, None, None, None), (None, "u\r\nv", "é", "")]
    pages = spark.createDataFrame(rows, PAGES).coalesce(2)
    good = warc.archive(pages, f"{tmp_path}/good", file_bytes=file_bytes)
    assert good.count() == 62
    places = sorted((r["file"], r["offset"], len(r["record"])) for r in good.collect())
    ends = {}
    for file, offset, length in places:
        assert offset == ends.get(file, 0)
        ends[file] = offset + length
    clean = warc.fixity(spark, good, good).collect()
    assert {r["status"] for r in clean} == {"intact"} and len(clean) == 62
    gone, changed = places[3][:2], places[40][:2]

    def at(place):
        return (F.col("file") == place[0]) & (F.col("offset") == place[1])

    twice = good.where(at(places[20]))
    new = good.where(at(places[5])).withColumn("offset", F.lit(10_000_000).cast("long"))
    spoilt = good.where(~at(gone)).withColumn("record", F.when(at(changed), F.lit(b"?")).otherwise(F.col("record")))
    found = warc.fixity(spark, good, spoilt.unionAll(twice).unionAll(new)).where("status <> 'intact'").collect()
    assert {(r["file"], r["offset"]): r["status"] for r in found} == {
        gone: "missing", changed: "changed", places[20][:2]: "changed", (places[5][0], 10_000_000): "extra"
    }


def test_damage_does_not_depend_on_how_pages_are_split(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.01/pages.parquet").repartition(7).write.parquet(f"{tmp_path}/pages.parquet")
    query = CATALOGUE["op9_warc_fixity"]
    found = [{r["page_id"]: r["status"] for r in query(spark, d).collect()} for d in (str(tmp_path), "/root/testdata/sf0.01")]
    assert found[0] == found[1] and len(set(found[0].values())) > 1


def test_very_long_records_and_columns_that_clash(spark, tmp_path):
    rows = [(i, "http://a", "y" * (3_000_000 if i == 2 else 10)) for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = pages.withColumns({"offset": F.lit("x"), "record": F.lit(1), "file": F.lit(None), "hash": F.lit("h")})
    good = warc.archive(clash, f"{tmp_path}/long", file_bytes=1_000_000)
    spoilt = good.withColumn("record", F.when(F.col("page_id") == 2, F.concat("record", F.lit(b"!"))).otherwise(F.col("record")))
    statuses = {r["page_id"]: r["status"] for r in warc.fixity(spark, good, spoilt).collect()}
    assert statuses == {0: "intact", 1: "intact", 2: "changed", 3: "intact"}


def test_an_audit_of_nothing(spark, tmp_path):
    none = warc.archive(spark.createDataFrame([], PAGES), f"{tmp_path}/none")
    assert warc.fixity(spark, none, none).count() == 0


def test_sound_files_are_not_descended(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * 900, "") for i in range(200)], PAGES).repartition(4)
    good = warc.archive(pages, f"{tmp_path}/g")
    spoilt = good.withColumn("record", F.when((F.col("file") == 0) & (F.col("offset") == 0), F.lit(b"")).otherwise(F.col("record")))
    one, other = (warc.Tree(r, warc.height_for(good, spoilt)) for r in (good, spoilt))
    assert len(one.levels) > 2 or one.levels[-1].count() <= 4
    assert [tuple(r) for r in warc.audit(one, other).collect()] == [(0, 0, "changed")]
