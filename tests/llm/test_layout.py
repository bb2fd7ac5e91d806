"""Sharding, token files, packing and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from rankmart.llm import packing, sharding, token_store
from rankmart.llm.queries import op7_sharding, table, tokenizer
from rankmart.llm.tokens import Encoder

SCHEMA = "doc_id long, text string, slot int"
ODD = [
    "", "plain words, it's 1,234!", "  two  spaces\n\n\tand tabs ", "Été déjà ÿ", "日本語 text",
    "<|endoftext|> inside", "a" * 5000, "x\r\ny \n", "don't WE'LL", "½ ² ª", "  nbsp", "'s 's",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(spark, name):
    known = Encoder(tokenizer(name))
    texts = ODD + [r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    texts.append(" ".join(texts) * 3)
    expected = [known.library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [list(ids) for ids in known.encode(texts)] == expected


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_packed_ids_come_back(bits):
    draw = np.random.default_rng(bits)
    for count in (0, 1, 63, 64, 65, 1000):
        ids = draw.integers(0, 1 << bits, count, dtype=np.uint64)
        payload = token_store.pack(ids, bits)
        assert len(payload) == -(-count // 64) * bits * 8
        assert (token_store.unpack(payload, bits, count) == ids).all()
        for at in draw.integers(0, count, 5) if count else []:
            assert token_store.id_at(payload, bits, int(at)) == ids[at]


def test_token_files(spark, tmp_path):
    path = tokenizer("byte_bpe_50k.json")
    rows = [(i * 7 % 101, t, 0) for i, t in enumerate(ODD * 3)] + [(None, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    token_store.write_tokens(docs, str(tmp_path / "t"), path, 2)
    found = token_store.read_tokens(spark, str(tmp_path / "t"), with_ids=True).collect()
    found = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [None, *sorted(r[0] for r in rows[:-1])]
    library = Encoder(path).library
    text, start = {r[0]: r[1] for r in rows}, 0
    for r in found:
        ids = [*library.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids, 2]
        assert r["start"] == start and r["n_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert list(np.frombuffer(r["ids"], "<u4")) == ids
        start += len(ids)
    token_store.write_tokens(docs.limit(0), str(tmp_path / "e"), path, 2)
    assert token_store.read_tokens(spark, str(tmp_path / "e")).isEmpty()


def check_places(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_plan_places_every_piece_once():
    draw = random.Random(4)
    for capacity, most, count in ((10, 10, 50), (64, 40, 500), (64, 3, 400), (4096, 4096, 800)):
        counts = Counter(draw.randint(1, most) for _ in range(count))
        made = packing.plan(counts, capacity)
        rows = []
        for length, n in counts.items():
            sequence, offset = made.place(np.full(n, length), np.arange(n))
            rows += [
                {"sequence_id": s, "offset": o, "length": length}
                for s, o in zip(sequence, offset, strict=True)
            ]
        used = check_places(rows, capacity)
        assert used == made.sequences
        assert used <= 1.05 * -(-sum(k * n for k, n in counts.items()) // capacity) + 2


def test_two_pieces_replace_the_smallest():
    # Greedy takes 6 and 3 of 10; 2 + 2 fill the place of the 3 better.
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10).sequences == 2
    taken = packing._two_for_smallest({6: 1, 3: 1}, 1, np.array([0, 0, 2, 1, 0, 0, 1]),
                                      np.array([2, 3, 6]))
    assert taken == {6: 1, 2: 2}


def test_packed_documents(spark):
    path = tokenizer("word_bpe_49k.json")
    long = " ".join(["word"] * 9000)
    rows = [(1, long, 0), (2, None, 0), (3, "", 0), (4, "a b c", 0), (4, "a b c", 0), (None, "x", 0)]
    docs = spark.createDataFrame(rows * 20, SCHEMA)
    found = packing.pack_documents(docs, path, 1).collect()
    check_places(found, 4096)
    assert Counter(r["doc_id"] for r in found)[1] == 20 * 3
    assert {r["length"] for r in found if r["doc_id"] in (2, 3)} == {1}
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) for r in found)
    packed = spark.createDataFrame(
        [(r["sequence_id"], r["offset"], r["ids"]) for r in found],
        "sequence_id long, offset long, ids binary",
    )
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in found)
    assert packing.pack_documents(docs.limit(0), path, 1).isEmpty()


def test_pieces_come_from_written_sequences(spark):
    from rankmart.llm.queries import packed

    path = tokenizer("word_bpe_49k.json")
    rows = [(1, " ".join(["word"] * 9000), 0), (2, None, 0), (4, "a b c", 0), (None, "x", 0)]
    docs = spark.createDataFrame(rows * 5, SCHEMA)
    found = packed(spark, docs, with_ids=True).collect()
    check_places(found, 4096)
    direct = packing.pack_documents(docs, path, 1)
    names = [c for c in direct.columns if c not in ("sequence_id", "offset")]
    expected = Counter(tuple(r) for r in direct.select(names).collect())
    assert Counter(tuple(r[n] for n in names) for r in found) == expected
    plain = packed(spark, docs)
    assert plain.columns == [c for c in direct.columns if c != "ids"]
    assert packed(spark, docs.limit(0)).isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) for r in last.collect())


def test_shards_are_level_and_keep_copies_together(spark):
    found = op7_sharding(spark, "/root/testdata/sf0.01").collect()
    sizes = Counter()
    slots = defaultdict(list)
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert max(sizes.values()) < 1.1 * min(sizes.values()) and len(sizes) == 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_group_that_fills_shards_is_split(spark):
    rows = [(i, "copy of one text", 0) for i in range(600)]
    rows += [(i, f"text {i} {'x' * (i % 50)}", 0) for i in range(600, 1200)]
    rows += [(None, None, 0), (5000, "", 0), (5000, "", 0)]
    found = sharding.shard_documents(spark.createDataFrame(rows, SCHEMA), 8).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) < 1.25 * sum(sizes.values()) / 8
    none = next(r for r in found if r["doc_id"] is None)
    assert (none["size"], none["text_crc32"]) == (1, 0)
    assert sharding.shard_documents(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark, tmp_path):
    words = [r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    clean = [t for t in words if len(t.split()) > 60][:6]
    item = table(spark, "/root/testdata/sf0.001", "benchmark").first()["text"]
    tail = " ".join(f"unseen{i}" for i in range(40))
    own = " ".join(f"own{i}" for i in range(40))
    rows = [(i, t, "en", "s", len(t), None) for i, t in enumerate(clean)]
    rows += [
        (100, clean[0], "en", "s", 1, None),
        (101, clean[1].rsplit(" ", 1)[0] + " changed", "en", "s", 1, None),
        (102, f"{tail} the {item} the end of it", "en", "s", 1, None),
        (103, None, "en", "s", 0, None),
        (104, "1234 !!", "en", "s", 7, None),
        (105, f"{' '.join(clean[2].split()[:55])} {own} and the rest", "en", "s", 1, None),
    ]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, _node int"
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    benchmark = table(spark, "/root/testdata/sf0.001", "benchmark")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).drop("_node")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        after.write.parquet(path)
        docs = spark.read.parquet(path)
        left.append({r["doc_id"] for r in docs.collect()})
        if name == "substring_dedup":
            cut = docs.filter("doc_id = 105").first()
            assert "own7" in cut["text"] and len(cut["text"].split()) < 60
            assert cut["n_chars"] == len(cut["text"])
    kept = set(range(6)) | {102, 105}
    assert left[0] == kept | {100, 101} and left[1] == left[2] == kept
    assert left[3] == left[4] == kept - {102}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    empty = table(spark, "/root/testdata/sf0.001", "documents").limit(0)
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    items = table(spark, "/root/testdata/sf0.001", "benchmark")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()


def test_ids_of_added_tokens_inside_texts_are_those_of_a_plain_call():
    from tokenizers import Tokenizer

    from rankmart.llm.tokens import Encoder

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        plain = Tokenizer.from_file(tokenizer(name))
        added = [t.content for t in plain.get_added_tokens_decoder().values()]
        texts = ["a <|endoftext|> b", "don't 's \n\n  x\ty", "", None, " lead", "Ünï 12345 ¡x!"]
        texts += [f"{pre}{t}{post}" for t in added for pre in ("", "A ", "x") for post in ("", " b")]
        texts += [t.upper() for t in added] + ["word " * 300 + added[0]]
        ours = [ids.tolist() for ids in Encoder(tokenizer(name)).encode(texts)]
        assert ours == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_places_are_the_same_with_joined_starts(spark):
    lengths = [(k, 1 + (k * 7919) % 37) for k in range(500)]
    rows = spark.createDataFrame(lengths, "id long, length long").repartition(7)
    schema = "id long, length long, _part int, _number long"
    numbered = rows.mapInArrow(packing._numbered, schema)
    for most in (0, 10_000):
        packed = packing.deal(numbered, 40, max_starts=most).collect()
        assert sorted((r["id"], r["length"]) for r in packed) == lengths
        places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in packed)
        for one, two in zip(places, places[1:]):
            same = one[0] == two[0]
            assert two[1] == (one[1] + one[2] if same else 0) and two[1] + two[2] <= 40


def test_sequences_of_large_batches_are_read_as_written():
    import pyarrow as pa

    draw = np.random.default_rng(4)
    parts, expected = [], []
    for sequence in range(700):
        at, rows = 0, []
        for piece in range(int(draw.integers(1, 5))):
            ids = draw.integers(0, 1 << 16, int(draw.integers(1, 9))).astype("<u2")
            rows.append(
                {
                    "offset": at, "doc": None if piece == 3 else sequence, "piece": piece,
                    "start": 10 * piece, "length": len(ids), "ids": ids.tobytes(),
                }
            )
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            expected.append((rows[-1]["doc"], piece, 10 * piece, len(ids), crc, sequence, at))
            at += len(ids)
        draw.shuffle(rows)
        parts.append(rows)
    batch = pa.RecordBatch.from_pydict({"sequence_id": pa.array(range(700)), "parts": parts})
    written = list(packing._written(iter([batch])))
    read = [tuple(r.values()) for b in packing._read(iter(written), False) for r in b.to_pylist()]
    assert read == expected
