"""The manifest against a tree built in plain Python."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from feedlake.llm import op12_merkle_manifest as op

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree int"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return H(*(field(v) for v in row))


def tree(nodes):
    """(root, [(left, right) a level] per node)"""
    paths, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for i in range(0, len(nodes), 3):
            run = nodes[i : i + 3]
            for j in range(len(run)):
                for k in spans[i + j]:
                    paths[k].append(("".join(run[:j]), "".join(run[j + 1 :])))
        spans = [sum(spans[i : i + 3], []) for i in range(0, len(nodes), 3)]
        nodes = [H(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute_force(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf(r)))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    trees = {s: tree([leaf(r) for r in g]) for s, g in groups.items()}
    root, over = tree([t[0] for t in trees.values()])
    out = []
    for (s, g), above in zip(groups.items(), over, strict=True):
        for r, path in zip(g, trees[s][1], strict=True):
            path, h = path + above, r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                h = (*r[:4], r[4].replace("\n", ""))
            h = leaf(h)
            for left, right in path:
                h = H(left, h, right)
            out.append((r[0], leaf(r), trees[s][0], root, H(*(a + b for a, b in path)), h, h == root))
    return sorted(out, key=str)


def result(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(*r, 3, 5) for r in rows], SCHEMA).repartition(3)
    found = op.manifest(df).withColumn("proof", F.sha2("siblings", 256))
    names = ("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified")
    return sorted((tuple(r[c] for c in names) for r in found.collect()), key=str)


def doc(i, source, text="one\ntwo"):
    return (i, source, "en", len(text or ""), text)


@pytest.mark.parametrize("sizes", [[1], [3, 1], [82, 4, 81], [300, 28, 9, 2] + [1] * 30])
def test_trees(spark, sizes, monkeypatch):
    monkeypatch.setattr(op, "SHARE", 5)
    rows = [doc(1000 * s + 7 * i, f"src{s}", f"a{i}\nb") for s, n in enumerate(sizes) for i in range(n)]
    assert result(spark, rows) == brute_force(rows)


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(op, "LEVELS", 2)
    monkeypatch.setattr(op, "BLOCK", 9)
    rows = [doc(i, f"s{i % 100}") for i in range(230)]
    assert result(spark, rows) == brute_force(rows)


def test_edges(spark):
    rows = [doc(1, None), doc(None, None, None), doc(None, "é", ""), doc(4, "z", "x" * 100_000 + "\n"), (5, "z", None, None, "-"), doc(6, "Z", "tab\r\n")]
    rows += [doc(9, "z", "same\nrow")] * 40 + [doc(9, "z", f"tie {i}\n") for i in range(3)] + [doc(-2, "", "1:a")]
    assert result(spark, rows) == brute_force(rows)
    assert result(spark, []) == []
