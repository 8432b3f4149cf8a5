"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import string
import zlib

from grantsieve.llm import merkle

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n = row
    fields = [None if f is None else str(f) for f in (doc_id, source, lang, n, text)]
    return sha(*["-" if f is None else f"{len(f.encode())}:{f}" for f in fields])


def tree(nodes):
    """Root, and for each node the (before, behind) of its levels."""
    ways, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for w, a in zip(ways, at):
            first = a // 16 * 16
            w.append(("".join(level[first:a]), "".join(level[a + 1 : first + 16])))
        at = [a // 16 for a in at]
        level = [sha(*level[i : i + 16]) for i in range(0, len(level), 16)]
    return level[0], ways


def plain(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = []
    for s in sources:
        mine = [(r[0] is not None, r[0] or 0, leaf_of(r), r) for r in rows if r[3] == s]
        groups.append(sorted(mine, key=lambda x: x[:3]))
    trees = [tree([g[2] for g in group]) for group in groups]
    root, upper = tree([t[0] for t in trees])
    out = []
    for group, (subroot, ways), up in zip(groups, trees, upper):
        for (_, _, leaf, r), way in zip(group, ways):
            way, h = way + up, leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                h = leaf_of((r[0], None if r[1] is None else r[1].translate(LOWER), *r[2:]))
            for before, behind in way:
                h = sha(before, h, behind)
            out.append((r[0], leaf, subroot, root, sha(*[x for w in way for x in w]), h, h == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def digest(df):
    return sorted((tuple(r) for r in merkle.digest(df).collect()), key=repr)


def test_edges(edge, edge_rows, empty):
    got = digest(edge)
    assert got == plain(edge_rows)
    assert {r[-1] for r in got} == {True, False}
    assert merkle.digest(empty).count() == 0


def test_levels_and_many_sources(spark):
    """Sources of 1, 16, 17, 256, 257 and 4,200 rows, and enough others for two upper levels."""
    sizes = [1, 16, 17, 256, 257, 4200, *[1 + i % 3 for i in range(300)]]
    rows, at = [], 0
    for k, n in enumerate(sizes):
        for _ in range(n):
            rows.append((at * 7919 % 100_003, f"Text {at}", "en", f"src-{k}", at))
            at += 1
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert digest(df) == plain(rows)


def test_one_source_and_one_row(spark):
    one = [(5, "A", None, None, None)]
    assert digest(spark.createDataFrame(one, SCHEMA)) == plain(one)
    many = [(i, f"Some {i}", "en", "s", i) for i in range(40)] * 2
    assert digest(spark.createDataFrame(many, SCHEMA)) == plain(many)


def test_a_change_of_any_field_is_seen(spark):
    base = (5, "text", "en", "s", 4)
    rows = [base, (6, *base[1:]), (5, "texT", *base[2:]), (5, "text", None, "s", 4), (5, "text", "", "s", 4),
            (5, "text", "en", "t", 4), (5, "text", "en", "s", None)]
    leaves = merkle.leaves(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len({r["leaf"] for r in leaves}) == len(rows)
