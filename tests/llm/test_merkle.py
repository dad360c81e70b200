"""Merkle manifests against a plain tree that is kept whole."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from edge_cases import docs, texts

from emporium.llm import merkle, queries
from emporium.llm.common import table

SF = "/root/testdata/sf0.001"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text) -> str:
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def sides(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 8])))
        i //= 8
    return out


def expected(rows) -> list[tuple]:
    by_lang: dict = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    names = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for name in names:
        ordered = sorted(by_lang[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees.append((ordered, tree([leaf(r, r["text"]) for r in ordered])))
    top = tree([t[-1][0] for _, t in trees])
    root, out = top[-1][0], []
    for at, (ordered, levels) in enumerate(trees):
        for i, r in enumerate(ordered):
            proof = sides(levels, i) + sides(top, at)
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]) if tampered else r["text"]
            node = leaf(r, text)
            for a, b in proof:
                node = h(a, node, b)
            out.append((r["doc_id"], levels[0][i], levels[-1][0], root, h(*(x for s in proof for x in s)), node, node == root))
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def write(spark, path, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, pos long, digest string")
    frame.write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_whole_table(spark):
    want = expected(table(spark, SF, "documents").collect())
    result = got(queries.op12_merkle_manifest(spark, SF))
    assert result == want
    assert {r[-1] for r in result} == {True, False}


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, "de": 9}, {"en": 513, None: 1, "": 65}, {"en": 1100, "é": 512, "zz": 3, "Z": 64}])
def test_sizes_around_the_stored_levels(spark, tmp_path, sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 37 % 5003, f"Text {i} É", lang, None if i % 5 else "S", None if i % 7 else i, 1, "x"))
    folder = write(spark, tmp_path, rows)
    assert got(queries.op12_merkle_manifest(spark, folder)) == expected(table(spark, folder, "documents").collect())


def test_edge_rows(spark, tmp_path):
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or ""), 5, "d") for i, t in enumerate(texts())]
    rows += [rows[3], rows[3], (None, "No id", "en", None, None, 1, None), (None, None, None, None, None, None, None)]
    rows += [(4, "The same id, another text", "en", "s", 1, 2, "y")]
    folder = write(spark, tmp_path, rows)
    assert got(queries.op12_merkle_manifest(spark, folder)) == expected(table(spark, folder, "documents").collect())


def test_empty_table(spark, tmp_path):
    folder = write(spark, tmp_path, [])
    assert queries.op12_merkle_manifest(spark, folder).collect() == []


def test_many_trees_and_hot_one(spark):
    """600 groups, so that the tree over their roots has a stored level too."""
    rows = docs(spark, [(i, f"t{i}") for i in range(2000)]).selectExpr("doc_id", "text", "cast(if(doc_id < 1400, 0, doc_id) as string) AS lang", "start AS source", "doc_id AS n_chars")
    manifest = merkle.build(rows)
    found = merkle.proofs(manifest)
    bad = found.where(merkle.folded(found["digest"]) != manifest.root).count()
    assert bad == 0 and found.count() == 2000
    assert expected(rows.collect())[0][3] == manifest.root
