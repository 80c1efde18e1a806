import zlib

from cohortcraft.llm import kd_shards


def _docs(n=400):
    out = [(k, "x" * ((k * 37) % 900) + " é") for k in range(n)]
    return out + [(10**6 + k, "copy of one text " * 5) for k in range(n // 2)] + [(None, None), (7, None), (7, None)]


def test_shards_are_even_and_slots_gapless(spark, docs_of, monkeypatch):
    monkeypatch.setattr(kd_shards, "SLOT_BLOCK", 10)
    pairs = _docs()
    rows = kd_shards.shard(docs_of(pairs), shards=6).collect()
    assert len(rows) == len(pairs)
    sizes, slots = {}, {}
    for r in rows:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(sizes) == list(range(6))
    mean = sum(sizes.values()) / 6
    assert max(sizes.values()) <= 1.1 * mean + 910 and min(sizes.values()) >= 0.9 * mean - 910
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    known = {(i, zlib.crc32((t or "").encode())): len((t or "").encode()) + 8 for i, t in pairs}
    assert all(known[(r.id, r.crc)] == r.size for r in rows)


def test_target_bytes_fix_the_leaves_and_edges(spark, docs_of):
    docs = docs_of(_docs(100))
    total = sum(r.size for r in kd_shards.shard(docs, shards=1).collect())
    assert kd_shards.shard(docs, target_bytes=total // 5 + 1).select("shard").distinct().count() == 5
    assert kd_shards.shard(docs.limit(0), shards=4).count() == 0
    few = kd_shards.shard(docs_of([(1, "a"), (2, "b")]), shards=4).collect()
    assert len(few) == 2 and all(r.slot == 0 for r in few) or len({r.shard for r in few}) == 1


def test_native(spark, docs_of):
    plan = kd_shards.shard(docs_of([(1, "a b"), (2, "c")]), shards=3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_tree_against_plain_splits(spark, docs_of):
    """Every node: the widest dimension, and the threshold nearest to the wanted bytes of all thresholds there are."""
    docs = docs_of(_docs(300))
    dims = kd_shards.DIMENSIONS
    points = kd_shards._coordinates(kd_shards._raw(docs, dims, "doc_id", "text"), len(dims))
    rows = [(r["size"], tuple(r[f"c{k}"] for k in range(len(dims)))) for r in points.collect()]
    root = kd_shards.kd_tree(points, 7, len(dims))
    leaves = []

    def check(node, inside):
        if node.left is None:
            leaves.append((node.first, inside))
            return
        total = sum(s for s, _ in inside)
        widths = [(max(c[k] for _, c in inside) >> kd_shards.TIE_BITS) - (min(c[k] for _, c in inside) >> kd_shards.TIE_BITS) for k in range(len(dims))]
        assert node.dim == widths.index(max(widths))
        want, below, off = total * (node.leaves // 2) / node.leaves, 0, [total * (node.leaves // 2) / node.leaves]
        by_value = {}
        for s, c in inside:
            by_value[c[node.dim]] = by_value.get(c[node.dim], 0) + s
        for value in sorted(by_value):
            below += by_value[value]
            off.append(abs(below - want))
        left = [r for r in inside if r[1][node.dim] <= node.at]
        assert abs(sum(s for s, _ in left) - want) <= min(off) + 1e-3 * total / node.leaves + 1e-6
        check(node.left, left)
        check(node.right, [r for r in inside if r[1][node.dim] > node.at])

    check(root, rows)
    assert [f for f, _ in leaves] == list(range(7))
    shards = {}
    for r in kd_shards.shard(docs, shards=7).collect():
        shards[r.shard] = shards.get(r.shard, 0) + 1
    assert shards == {f: len(inside) for f, inside in leaves if inside}
