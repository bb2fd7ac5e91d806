"""License scan, decontamination, substring and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest

from rankmart.llm import decontaminate, license_scan, near_dedup, substring_dedup
from rankmart.llm.components import components

SCHEMA = "doc_id long, text string, lang string, words int"


def frame(spark, texts):
    """Documents numbered from 0, with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, None, 1) for i, t in enumerate(texts)], SCHEMA)


def by_id(df, id="doc_id"):
    return {r[id]: r for r in df.collect()}


def prose(draw, n, size=40):
    return " ".join(f"w{draw.randrange(size)}" for _ in range(n))


def test_license_places_and_labels(spark):
    texts = [
        "MIT License, mit license. GNU general-public LICENSE",
        "Permission is hereby granted, free of charge, to any bold person obtaining a copy of "
        "this software and associated documentation files",
        "gnu general license public",
        "",
        None,
        "mit éLicense K cc by",
    ]
    found = by_id(license_scan.license_scan(frame(spark, texts)))
    assert len(found) == len(texts)
    first = found[0]
    assert (first["n_words"], first["n_base"], first["first_word"], first["last_word"]) == (
        8, 3, 0, 4,
    )
    assert first["base_labels"] == first["labels"] == "gpl,mit" and first["score"] == 1.0
    assert found[1]["labels"] == "mit" and found[1]["base_labels"] == ""
    assert 0.75 <= found[1]["score"] < 1
    assert found[2]["n_base"] == 0 and found[2]["first_word"] is None
    for i in (3, 4):
        assert (found[i]["n_words"], found[i]["labels"], found[i]["score"]) == (0, "", 0.0)
    assert found[5]["base_labels"] == "cc-by" and found[5]["first_word"] == 3


def test_license_labels_need_the_words_that_tell_them_apart(spark):
    notice = (
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU {} General Public License as published"
    )
    texts = {
        "Licensed under CC BY 4.0": "cc-by",
        "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc",
        "Licensed under CC BY-SA 4.0": "cc-by,cc-by-sa",
        notice.format(""): "gpl",
        notice.format("Lesser"): "lgpl",
        notice.format("Affero"): "agpl",
    }
    found = by_id(license_scan.license_scan(frame(spark, list(texts))))
    assert [found[i]["labels"] for i in range(len(texts))] == list(texts.values())


def test_license_bodies_without_their_opening_words(spark):
    bodies = {t.text: t.label for t in license_scan.PARAGRAPHS}
    long = " ".join(f"term{i}" for i in range(300))
    texts = [" ".join(["before", *t.split()[6:], "after"]) for t in bodies] + [long]
    unlicense = license_scan.PARAGRAPHS[1].text.replace("authors or copyright holders", "authors")
    wanted = [*bodies.values(), "whole", ""]
    templates = [*license_scan.TEXTS, license_scan.Template("whole", long)]
    docs = frame(spark, [*texts, unlicense])
    found = by_id(license_scan.license_scan(docs, texts=templates))
    assert [found[i]["labels"] for i in range(len(wanted))] == wanted


def test_license_repeated_rows_and_empty_table(spark):
    docs = frame(spark, ["mit license"])
    twice = docs.union(docs).union(docs.selectExpr("NULL", "text", "lang", "words"))
    assert license_scan.license_scan(twice).filter("n_base = 1").count() == 3
    assert license_scan.license_scan(docs.limit(0)).isEmpty()


def test_any_two_substitutions_in_thirteen_words_leave_a_seed():
    masks = [{x for at in mask for x in (at, at + 1)} for mask in decontaminate.MASKS]
    for wrong in itertools.combinations(range(13), 2):
        assert any(
            not any(start + place in wrong for place in mask)
            for mask in masks
            for start in range(13 - max(mask))
        )


def brute_leaks(docs, items):
    found = set()
    for (d, doc), (i, item) in itertools.product(enumerate(docs), enumerate(items)):
        doc, item = (doc or "").split(), (item or "").split()
        width = min(13, len(item))
        need = 11 if len(item) >= 13 else len(item)
        if len(item) < 6:
            continue
        for p in range(len(doc) - width + 1):
            for t in range(len(item) - width + 1):
                if sum(doc[p + k] == item[t + k] for k in range(width)) >= need:
                    found.add((d, i))
    return found


def test_leaks_against_brute_force(spark):
    draw = random.Random(1)
    items = [prose(draw, n, 500) for n in (30, 20, 13, 12, 7, 5)] + [None, ""]
    docs = [prose(draw, 40, 500) for _ in range(6)] + [None, "", "w1"]
    for item in items[:6]:
        words = item.split()
        for wrong in range(5):
            changed = list(words)
            for at in draw.sample(range(len(words)), min(wrong, len(words))):
                changed[at] = "other"
            docs.append(f"{prose(draw, 9, 500)} {' '.join(changed)} {prose(draw, 9, 500)}")
            docs.append(" ".join(changed[: len(words) // 2 + 2]))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontaminate.leaks(frame(spark, docs), bench)
    expected = brute_leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == expected and expected
    shuffled = decontaminate.leaks(frame(spark, docs), bench, max_broadcast=3)
    assert {(r["doc_id"], r["item_id"]) for r in shuffled.collect()} == expected
    clean = decontaminate.without_leaks(frame(spark, docs), bench)
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(docs))) - {
        d for d, _ in expected
    }
    assert clean.columns == ["doc_id", "text", "lang", "words"]
    assert decontaminate.leaks(frame(spark, docs).limit(0), bench).isEmpty()
    assert decontaminate.leaks(frame(spark, docs), bench.limit(0)).isEmpty()


def test_a_benchmark_too_large_to_broadcast(spark):
    """The same rows, and no text goes along with a seed."""
    draw = random.Random(5)
    items = [prose(draw, 40, 5_000) for _ in range(5)]
    long = prose(draw, 20_000, 5_000).split()
    long[11_000:11_020] = items[0].split()[7:27]
    long[19_985:] = items[1].split()[:15]
    bench = spark.createDataFrame(
        [(f"item {i}" if i else None, t, "x") for i, t in enumerate(items)],
        "item_id string, text string, seed string",
    )
    texts = [(None, " ".join(long)), (3, items[2]), (3, items[2]), (3, "other"), (None, None)]
    docs = spark.createDataFrame([(*r, None, 1) for r in texts], SCHEMA)
    found = {}
    for size in (0, decontaminate.MAX_BROADCAST):
        rows = decontaminate.leaks(docs, bench, max_broadcast=size).collect()
        found[size] = sorted(rows, key=str)
    assert found[0] == found[decontaminate.MAX_BROADCAST] and len(found[0]) == 3
    # The first passage begins with two words that differ, as 11 of 13 are enough.
    assert {r["first_word"] for r in found[0] if r["doc_id"] is None} == {10_998, 19_985}
    worded = docs.selectExpr("doc_id doc", "xxhash64(text) key", "split(text, ' ') words")
    seeds = decontaminate.test_seeds(bench)
    assert decontaminate._held_bytes(seeds) > 5 * 38 * decontaminate.SEED_BYTES
    assert decontaminate._held_bytes(seeds.limit(0)) == 0
    hits = decontaminate._hits(worded, seeds, 0)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    joins = [n for n, line in enumerate(plan.splitlines()) if "Join Inner, (seed" in line]
    assert joins, plan
    generated = next(x for x in plan.splitlines()[joins[0]:] if "Project" in x and "seed" in x)
    assert "words" not in generated.replace("n_words", "").replace("item_words", "")


def test_clean_texts_with_the_id_of_a_leaking_one_stay(spark):
    item = " ".join(f"item{i}" for i in range(15))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"a {item}"), (None, "clean"), (None, None), (7, f"b {item}"), (7, "other")]
    docs = spark.createDataFrame([(*r, None, 1) for r in rows], SCHEMA)
    left = decontaminate.without_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["text"]) for r in left} == {(None, "clean"), (None, None), (7, "other")}
    assert len(left) == 3


def brute_repeats(rows, width=13):
    """For each row its words and which of them stay."""
    starts = {}
    split = [(d, (t or "").split()) for d, t in rows]
    for d, words in split:
        for p in range(len(words) - width + 1):
            if d is not None:
                key = tuple(words[p : p + width])
                starts[key] = min(d, starts.get(key, d))
    out = []
    for d, words in split:
        gone = set()
        for p in range(len(words) - width + 1):
            if d is not None and starts[tuple(words[p : p + width])] < d:
                gone |= set(range(p, p + width))
        out.append((d, len(words), [w for p, w in enumerate(words) if p not in gone]))
    return out


def test_repeated_windows_against_brute_force(spark):
    draw = random.Random(2)
    shared = [prose(draw, n, 300) for n in (12, 13, 14, 30, 70)]
    rows = []
    for d in range(60):
        parts = [prose(draw, draw.randrange(25), 300), draw.choice(shared), draw.choice(shared)]
        draw.shuffle(parts)
        rows.append((d, " \n".join(parts)))
    rows += [(60, None), (61, ""), (None, rows[3][1]), (5, rows[7][1]), (5, rows[5][1])]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    found = substring_dedup.without_repeats(docs)
    got = sorted(
        (str(r["doc_id"]), r["span_words"], r["span_removed"], r["span_sha256"])
        for r in found.collect()
    )
    expected = sorted(
        (str(d), n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
        for d, n, kept in brute_repeats(rows)
    )
    assert got == expected and any(r[2] for r in got)
    for row in found.filter("span_kept IS NOT NULL").collect():
        assert hashlib.sha256(row["span_kept"].encode()).hexdigest() == row["span_sha256"]
    assert substring_dedup.without_repeats(docs.limit(0)).isEmpty()


def test_cover_reaches_every_shift():
    period, cover = substring_dedup.PERIOD, substring_dedup.COVER
    for i, j in itertools.product(range(period), repeat=2):
        assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))


def aligned_similarity(a, b):
    """Order-aware similarity by plain dynamic programming over labelled shingles."""
    def labelled(text):
        words, seen, out = (text or "").lower().split(), {}, []
        for p in range(max(len(words) - 4, min(1, len(words)))):
            key = tuple(words[p : p + 5])
            seen[key] = seen.get(key, 0) + 1
            out.append((key, seen[key]))
        return out

    x, y = labelled(a), labelled(b)
    if not x or not y:
        return float(len(x) == len(y))
    best = np.zeros((len(x) + 1, len(y) + 1), int)
    for i, j in itertools.product(range(len(x)), range(len(y))):
        best[i + 1, j + 1] = (
            best[i, j] + 1 if x[i] == y[j] else max(best[i, j + 1], best[i + 1, j])
        )
    common = best[-1, -1]
    return common / (len(x) + len(y) - common)


def test_near_duplicate_classes_against_brute_force(spark):
    draw = random.Random(3)
    texts = [prose(draw, draw.randrange(30, 90), 2000) for _ in range(8)]
    for base in list(texts):
        words = base.split()
        texts.append(base)
        for changes in (1, 1, 2, 4, 12):
            copy = list(words)
            for _ in range(changes):
                copy[draw.randrange(len(copy))] = f"new{draw.randrange(99)}"
            texts.append(" ".join(copy))
        texts.append(" ".join(words[30:] + words[:30]))
    texts += [None, "", "one two", "One two", "one three", " ".join(["again"] * 30)]
    known = {i: i for i in range(len(texts))}

    def root(i):
        while known[i] != i:
            i = known[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if aligned_similarity(texts[i], texts[j]) >= 0.8:
            a, b = sorted((root(i), root(j)))
            known[b] = a
    found = by_id(near_dedup.near_duplicates(frame(spark, texts)))
    assert {i: r["class_id"] for i, r in found.items()} == {i: root(i) for i in known}
    assert all(r["kept"] == (r["class_id"] == i) for i, r in found.items())
    docs = frame(spark, texts)
    kept = near_dedup.one_of_each(docs.union(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({root(i) for i in known})
    assert kept.columns == docs.columns
    assert near_dedup.near_duplicates(docs.limit(0)).isEmpty()


def test_near_duplicates_in_a_large_family_of_unlike_texts(spark):
    # All share 150 words and are 0.74 alike; planted pairs share eight more and are 0.81.
    template = " ".join(f"t{i}" for i in range(150))

    def own(name, n):
        return " ".join(f"{name}x{i}" for i in range(n))

    texts = []
    for pair in range(100):
        for one in range(2):
            texts.append(f"{template} {own(f'p{pair}', 8)} {own(f'q{pair}and{one}', 18)}")
    texts += [f"{template} {own(f's{i}', 26)}" for i in range(100)]
    found = by_id(near_dedup.near_duplicates(frame(spark, texts)))
    expected = {i: i - i % 2 if i < 200 else i for i in range(300)}
    assert {i: r["class_id"] for i, r in found.items()} == expected


def test_near_duplicates_of_members_of_a_large_class(spark):
    # Copies are 0.93 like the base; a stray is 0.81 like one copy and below 0.8 to the base.
    words = [f"b{i}" for i in range(150)]
    texts = [" ".join(words)]
    for i in range(300):
        copy = list(words)
        copy[10 + i % 60] = f"c{i}"
        texts.append(" ".join(copy))
        if i % 6 == 0:
            for at in (90, 110, 130):
                copy[at] = f"d{i}"
            texts.append(" ".join(copy))
    found = near_dedup.near_duplicates(frame(spark, texts)).collect()
    assert len(found) == len(texts) and {r["class_id"] for r in found} == {0}


def test_one_row_of_each_class_with_null_and_shared_ids(spark):
    words = [f"n{i}" for i in range(60)]
    rows = [(None, " ".join([*words, f"end{i}"])) for i in range(4)]
    rows += [(5, " ".join(["x" + w for w in words] + [f"end{i}"])) for i in range(3)]
    docs = spark.createDataFrame([(*r, None, 1) for r in rows * 2], SCHEMA)
    left = near_dedup.one_of_each(docs).collect()
    assert sorted(str(r["doc_id"]) for r in left) == ["5", "None"]


def test_near_duplicates_of_few_words(spark):
    texts = []
    for i in range(2500):
        words = [f"v{i}x{k}" for k in range(9)]
        texts += [" ".join(words[:8]), " ".join(words)]
    found = by_id(near_dedup.near_duplicates(frame(spark, texts)))
    assert {i: r["class_id"] for i, r in found.items()} == {i: i - i % 2 for i in found}


def test_similarity_needs_the_order():
    a = np.arange(100, dtype=np.uint64)
    assert near_dedup.similarity(a, a) == 1.0
    assert near_dedup.similarity(a, np.roll(a, 50)) == 0.0
    assert near_dedup.similarity(a, a[:85]) == pytest.approx(0.85)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(7, 7)]
    roots = components(spark.createDataFrame(edges, "a long, b long"))
    found = {r["node"]: r["root"] for r in roots.collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 120)}}


def test_one_row_of_a_class_is_kept(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(None, text)] * 3 + [(7, "other " + text[::-1])] * 2 + [(9, "alone"), (None, "odd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(docs).collect()
    kept = [(r["doc_id"], r["class_id"]) for r in got if r["kept"]]
    assert sorted(kept, key=str) == [(7, 7), (9, 9), (None, None), (None, None)]
    assert near_dedup.one_of_each(docs).count() == len(kept)
    named = spark.createDataFrame([("a", text), ("b", text)], "doc_id string, text string")
    assert sum(r["kept"] for r in near_dedup.near_duplicates(named).collect()) == 1
