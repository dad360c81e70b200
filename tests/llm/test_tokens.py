"""Token store, packing and prefix counts against the tokenizer library itself."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from edge_cases import docs, empty, pairs, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emporium.llm import packing, queries, token_counts, token_store
from emporium.llm.common import scratch, table
from emporium.llm.wordbpe import encoder

PATH = queries.tokenizer_file()
LIBRARY = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.001"


def ids_of(text: str | None) -> list[int]:
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" .,'sredlvtmZé́ß<|>09\n"), st.characters(codec="utf-8")), max_size=30), max_size=5))
@settings(max_examples=300, deadline=None)
def test_ids_and_prefix_counts_are_the_librarys(batch):
    raw = [t.encode() for t in batch]
    assert [list(x) for x in encoder(PATH).ids(raw)] == [ids_of(t) for t in batch]
    for text, steps in zip(batch, token_counts.steps_of(raw, PATH), strict=True):
        for i in range(len(text) + 1):
            assert token_counts.tokens_at(steps, len(text[:i].encode())) == len(ids_of(text[:i]))


def test_contractions_and_special_strings():
    batch = ["we're don't it's 's 're're !'s ''s a's's 'sun", "<|endoftext|>x y<|startoftext|>", "MIXED Case ÀÉß"]
    assert [list(x) for x in encoder(PATH).ids([t.encode() for t in batch])] == [ids_of(t) for t in batch]


LONG_RUNS = {
    "chinese": "我们在河边看见一座古老的石桥，桥下的水流很慢。孩子们说：“明天再来吧！”" * 8,
    "unbroken chinese": "".join(chr(0x4E00 + i * i * 37 % 5000) for i in range(200)),
    "japanese": "がぎ川の石橋をゆっくり渡ると、カﾞタカナと漢字が混ざる。" * 6,
    "thai": "สะพานหินเก่าแก่ข้ามแม่น้ำและเด็กๆกำลังเล่นน้ำ" * 4,
    "hangul": "한국어 문장".replace(" ", "") * 20 + "\u1112\u1161\u11ab" * 30,
    "hindi": "नदीकेकिनारेपुरानापत्थरकापुल\u0958" * 6,
    "letters": "internationalisationofunbrokenwordsandxxxxxxxxyyzzz" * 5,
    "one letter": "x" * 300 + "é",
    "signs": "!?'" * 80 + "ß",
    "contractions": "中we'rest'll's''sİ'd!'ve're'l'" * 8,
    "contractions with marks": "中're\u0301x'll\u0323y's\u0327'" * 12,
    "long runs of marks": ("'re" + "\u0317\u0301\u0323\u0327" * 12 + "é!'" + "\u0301" * 40 + "'ll") * 4,
    "marks": "a" + "\u0301\u0323\u0327" * 40 + "bİ̇!i̇!" * 10,
    "special strings": "é<|endoftext|>中<|endoft<|startoftext|><|ENDOFTEXT|>'s" * 4,
    "spaces of other kinds": "é\u00a0a\u3000中\u2003'\u00a0s1٣½" * 9,
}


@pytest.mark.parametrize("name", LONG_RUNS)
def test_prefix_counts_inside_long_runs(name):
    text = LONG_RUNS[name]
    steps = token_counts.steps_of([text.encode()], PATH)[0]
    got = [token_counts.tokens_at(steps, len(text[:i].encode())) for i in range(len(text) + 1)]
    assert got == [len(ids_of(text[:i])) for i in range(len(text) + 1)]


def test_limit_inside_a_text_without_white_space(spark):
    rows = [(1, LONG_RUNS["chinese"] * 9), (2, "x" * 30_000), (3, "é" + "ab!" * 4000)]
    for r in token_counts.prefix_table(docs(spark, rows), PATH, limit=2048).collect():
        text = dict(rows)[r["doc_id"]]
        kept = text.encode()[: r["limit_bytes"]].decode()
        assert r["n_tokens"] == len(ids_of(text)) > 2048
        assert len(ids_of(kept)) <= 2048 < len(ids_of(text[: len(kept) + 1]))


def test_very_long_text_is_cut_at_white_space():
    text = ("river Stone, don't " * 60_000) + "x" * 700_000
    got = encoder(PATH).ids([b"a", text.encode(), b"b"])
    assert list(got[0]) == ids_of("a") and list(got[2]) == ids_of("b")
    assert list(got[1]) == ids_of(text)


def test_full_piece_table_is_emptied(monkeypatch):
    from emporium.llm import wordbpe

    monkeypatch.setattr(wordbpe, "KEPT", 64)
    enc = wordbpe.WordEncoder(PATH)
    batch = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(a, a + 40)) for a in (0, 40, 80, 0)]
    for one in batch:
        assert list(enc.ids([one.encode()])[0]) == ids_of(one)


def test_prefix_table(spark):
    rows = docs(spark)
    got = token_counts.prefix_table(rows, PATH, limit=50).collect()
    want = Counter((i, len((t or "").encode()), len(ids_of(t))) for i, t in pairs(rows))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    by_id = dict(pairs(rows))
    for r in got:
        raw = (by_id[r["doc_id"]] or "").encode()
        kept = raw[: r["limit_bytes"]].decode()
        assert len(ids_of(kept)) <= 50
        if r["n_tokens"] <= 50:
            assert r["limit_bytes"] == len(raw)
    assert token_counts.prefix_table(empty(spark), PATH).count() == 0


def test_op5_whole_table(spark):
    want = {i: (len((t or "").encode()), len(ids_of(t))) for i, t in pairs(table(spark, SF, "documents"))}
    got = queries.op5_token_counts(spark, SF).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)


@pytest.mark.parametrize("n,want", [(1, [1]), (7, [4, 2, 1]), (8, [8]), (19, [8, 8, 2, 1]), (16, [8, 8])])
def test_binary_pieces(n, want):
    assert packing.piece_lengths(n, 8) == want


def check_pieces(rows, pieces):
    """Each id of each document lies in exactly one piece, sequences are powers of two."""
    want = Counter((i, tuple(ids_of(t) + [1])) for i, t in rows)
    got, at = Counter(), None
    for p in sorted(pieces, key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["sequence_id"] & (1 << 58) - 1)):
        assert p["offset"] == 0 and p["length"] & (p["length"] - 1) == 0
        if p["start"] == 0:
            at = []
        at += np.frombuffer(p["ids"], "<u4").tolist()
        assert len(at) == p["start"] + p["length"]
        if len(at) == p["doc_tokens"]:
            got[p["doc_id"], tuple(at)] += 1
    assert got == want
    ids = [p["sequence_id"] for p in pieces]
    assert len(set(ids)) == len(ids)
    by_bucket = sorted((p["sequence_id"], p["bucket"]) for p in pieces)
    assert [b for _, b in by_bucket] == sorted(b for _, b in by_bucket)


def test_packing_is_a_partition_of_all_ids(spark):
    rows = docs(spark).coalesce(1)
    check_pieces(pairs(rows), packing.pack(rows, PATH, max_len=256).collect())
    assert packing.pack(empty(spark), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(rows, PATH, max_len=100)


def test_op2_digests(spark):
    want = {i: ids_of(t) + [1] for i, t in pairs(table(spark, SF, "documents"))}
    got = queries.op2_packing(spark, SF).collect()
    assert all(crc(want[r["doc_id"]][r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] for r in got)
    assert sum(r["length"] for r in got) == sum(map(len, want.values()))


def test_store_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_DOCS", 3)
    rows, path = docs(spark), scratch(spark, "test-store")
    token_store.write_store(rows, path, PATH)
    got = token_store.read_store(spark, path, PATH).orderBy("start").collect()
    want = Counter((i, tuple(ids_of(t) + [2])) for i, t in pairs(rows))
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    keys = [(-1 if r["doc_id"] is None else r["doc_id"]) for r in got]
    assert keys == sorted(keys)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [x.tolist() for x in token_store.read_document(spark, path, PATH, 4)] == [ids_of(texts()[4]) + [2]]
    assert len(token_store.read_document(spark, path, PATH, 6)) == 2
    assert token_store.read_document(spark, path, PATH, 999) == []


def test_store_of_nothing(spark):
    path = scratch(spark, "test-store")
    token_store.write_store(empty(spark), path, PATH)
    assert token_store.read_store(spark, path, PATH).count() == 0


def test_op1_whole_table(spark):
    want, at = {}, 0
    for i, t in sorted(pairs(table(spark, SF, "documents"))):
        ids = ids_of(t) + [2]
        want[i] = (at, len(ids), crc(ids))
        at += len(ids)
    got = queries.op1_token_store(spark, SF).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want


def test_one_dictionary_and_small_frames(spark):
    path = scratch(spark, "test-store")
    token_store.write_store(table(spark, SF, "documents"), path, PATH)
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.select("dict_hash").distinct().count() == 1
    size = blocks.agg(F.sum(F.octet_length("frames")), F.sum("n_tokens")).first()
    assert size[0] < 2 * size[1]  # smaller than the plain 16-bit ids
