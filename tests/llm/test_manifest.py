"""The Merkle manifest against a tree built by hand, and its forests against any order of merges."""

import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from thicket.llm import manifest
from thicket.llm.manifest import Forest, digest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, `a.b` int, digest string"


def levels(leaves, arity=2):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def siblings(tree, i, arity=2):
    out = []
    for level in tree[:-1]:
        first = i - i % arity
        out.append((i - first, [h for k, h in enumerate(level[first : first + arity]) if k != i - first]))
        i //= arity
    return out


def folded(h, path):
    for place, others in path:
        h = digest([*others[:place], h, *others[place:]])
    return h


def leaf(r, more=0):
    show = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(show(v) for v in (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1]))


def expected(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows, built level by level."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for v in by.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {k: levels([leaf(r) for r in v]) for k, v in by.items()}
    top = levels([trees[k][-1][0] for k in names])
    out = []
    for k, v in by.items():
        upper = siblings(top, names.index(k))
        for i, r in enumerate(v):
            path = siblings(trees[k], i) + upper
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            f = folded(leaf(r, 1 if bad else 0), path)
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], digest(h for _, o in path for h in o), f, f == top[-1][0]))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS)


def rows():
    r = random.Random(3)
    out = [(i, "é" * r.randint(0, 9) + str(i), r.choice(["en", "en", "en", "de", "ü", "", None]), r.choice(["s", None]), r.choice([i, None])) for i in range(-40, 260)]
    out += [out[5]] * 6 + [(7, None, "en", "s", 1), (7, "", "en", "s", 1), (None, "x", "en", None, 2), (None, None, None, None, None), (999, "one of its language", "zz", "s", (1 << 63) - 1)]
    return out + [(1000, "long " * 300_000, "en", "s", 1_500_000)]


@pytest.mark.parametrize("leaves, fan", [(1 << 16, 64), (9, 3)])
def test_rows_equal_a_tree_built_by_hand(spark, monkeypatch, leaves, fan):
    monkeypatch.setattr(manifest, "LEAVES", leaves)
    monkeypatch.setattr(manifest, "FAN", fan)
    got = manifest.verified_rows(table(spark, rows()), manifest.tampered_by_id())
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows())


def test_manifest_of_languages(spark):
    got = {r.lang: (r.n_leaves, r.subroot, r.root) for r in manifest.manifest(table(spark, rows())).collect()}
    want = {}
    for r in rows():
        want[r[2]] = want.get(r[2], 0) + 1
    assert {k: v[0] for k, v in got.items()} == want
    assert len({v[2] for v in got.values()}) == 1 and {v[1] for v in got.values()} == {x[2] for x in expected(rows())}


def test_untampered_rows_verify_and_one_change_moves_the_root(spark):
    got = manifest.verified_rows(table(spark, rows()[:50])).collect()
    assert all(r.verified for r in got)
    changed = [*rows()[:49], (*rows()[49][:1], "another", *rows()[49][2:])]
    assert manifest.verified_rows(table(spark, changed)).first().root != got[0].root


def test_empty_table(spark):
    assert manifest.verified_rows(table(spark, []), manifest.tampered_by_id()).count() == 0
    assert manifest.manifest(table(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 90), st.integers(2, 5), st.randoms())
def test_forests_merge_in_any_order(n, arity, r):
    leaves = [str(i) for i in range(n)]
    parts = [Forest(n, arity) for _ in range(r.randint(1, 8))]
    for i in r.sample(range(n), n):  # leaves of a part need not be neighbours
        r.choice(parts).add(0, i, leaves[i])
    while len(parts) > 1:
        a = parts.pop(r.randrange(len(parts)))
        b = parts.pop(r.randrange(len(parts)))
        parts.append(a.merge(b))
    tree = levels(leaves, arity)
    assert list(parts[0].open.values()) == tree[-1]
    whole = Forest(n, arity)
    for i, h in enumerate(leaves):
        whole.add(0, i, h)
    for i, h in enumerate(leaves):
        *_, met = whole.path(0, i)
        assert met == [x for _, o in siblings(tree, i, arity) for x in o]
        assert whole.fold(h, i, met) == tree[-1][0] and (whole.fold("?", i, met) != tree[-1][0])


def test_neighbouring_leaves_leave_few_nodes():
    forest = Forest(10_000)
    for i in range(1234, 7890):
        forest.add(0, i, str(i))
    assert len(forest.open) <= 2 * len(forest.widths)
