"""Vectors and conversations: edge cases and comparisons with brute force."""

import json
import random

import numpy as np
import pytest


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, score int, rank string")


def sample(n, dim=64, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


ODD = [(9001, None, 1), (9002, [], 1), (9003, [float("nan")] * 64, 1), (9004, [float("inf")] * 64, 1), (9005, [None] * 64, 1), (9006, [0.0] * 64, 1), (9007, [1.0] + [0.0] * 63, None)]


def test_topk_equals_brute_force(spark):
    from docketry.llm import topk

    v = sample(3000)
    v[7] = v[9]  # ties
    rows = [(k, v[k].tolist(), 0) for k in range(len(v))]
    got = topk.search(vectors(spark, rows + ODD), topk.F.col("vec_id") % 20 == 0, 20).collect()
    whole = np.floor(64 * v.astype(np.float64)).astype(np.int64)
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    extra = {9006: np.zeros(64, np.int64), 9007: np.floor(64 * np.array([1.0] + [0.0] * 63)).astype(np.int64), 9002: np.zeros(64, np.int64)}
    ids = np.array([*range(len(v)), *extra])
    everyone = np.concatenate([whole, np.stack(list(extra.values()))])
    assert set(found) == set(range(0, 3000, 20))
    for q in found:
        s = everyone @ whole[q]
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != q][:20]
        assert [found[q][n + 1] for n in range(20)] == [(ids[k], s[k]) for k in order]
    assert topk.search(vectors(spark, []), topk.F.col("vec_id") % 20 == 0).count() == 0
    few = topk.search(vectors(spark, rows[:3]), topk.F.col("vec_id") == 0).collect()
    assert len(few) == 2


def test_nra_bounds_are_safe_for_any_numbers():
    from docketry.llm import topk

    rng = np.random.default_rng(1)
    for scale in (3, 1000, 10**8):
        rows, queries = rng.integers(-scale, scale, (500, 6)), rng.integers(-scale, scale, (9, 6))
        ids = rng.permutation(500)
        for q, (best, scores) in zip(queries, topk.Lists(rows, ids).top(queries, np.full(9, -1), 5)[0], strict=True):
            s = rows @ q
            want = np.lexsort((ids, -s))[:5]
            assert best.tolist() == want.tolist() and scores.tolist() == s[want].tolist()


def test_nra_over_blocks_reads_less_than_half_of_clustered_rows(spark):
    from docketry.llm import topk

    rng = np.random.default_rng(8)
    centres = sample(40, seed=9)
    v = (centres[np.arange(4000) % 40] + rng.normal(scale=0.02, size=(4000, 64))).astype(np.float32)
    rows = vectors(spark, [(k, v[k].tolist(), 0) for k in range(len(v))])
    is_query = topk.F.col("vec_id") % 20 == 0
    read = topk.visits(rows, is_query, 20, rows=100).agg({"read": "sum"}).first()[0]
    share = read / (200 * 4000 * 64)
    print(f"share of list entries read: {share:.3f}")
    assert 0 < share < 0.5
    whole = np.floor(64 * v.astype(np.float64)).astype(np.int64)
    found = {}
    for r in topk.search(rows, is_query, 20, rows=100).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, got in found.items():
        s = whole @ whole[q]
        order = [k for k in np.lexsort((np.arange(4000), -s)) if k != q][:20]
        assert sorted(got) == [(n + 1, k, s[k]) for n, k in enumerate(order)]
    assert len(found) == 200


def test_topk_holds_large_numbers_exactly_or_raises(spark):
    from docketry.llm import topk

    large = float(1 << 22)  # 64 times this, squared, is beyond 2**53
    rows = [(0, [large, 1.0], 0), (1, [large, -1.0], 0), (2, [large - 1, 1.0], 0), (3, [-large, 0.0], 0)]
    got = topk.search(vectors(spark, rows), topk.F.col("vec_id") == 0, 3).collect()
    x = int(64 * large)
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, x * x - 4096), (2, x * (x - 64) + 4096), (3, -x * x)]
    with pytest.raises(OverflowError):
        topk.search(vectors(spark, [(0, [1e20], 0), (1, [-1e20], 0)]), topk.F.col("vec_id") == 0)


def test_lattice_points_are_nearest():
    from docketry.llm import lattice

    rng = np.random.default_rng(2)
    x = rng.normal(scale=3, size=(200, 8))
    home = lattice.nearest_e8(x)
    assert len(lattice.neighbours()) == 240 and np.allclose((lattice.neighbours() ** 2).sum(1), 2)
    distance = ((x - home) ** 2).sum(1)
    for v in lattice.neighbours():
        assert (distance <= ((x - home - v) ** 2).sum(1) + 1e-9).all()
    assert np.allclose((2 * home) % 1, 0) and np.allclose(home.sum(1) % 2, 0)


def test_lattice_dedup_against_brute_force(spark):
    from docketry.llm import lattice

    base = sample(400, seed=3)
    rng = np.random.default_rng(4)
    rows = [(k, base[k].tolist(), int(k % 3)) for k in range(400)]
    for k in range(300):  # partners around the threshold, copies, and copies under another label
        noise = rng.normal(size=64) * 0.34 / 8 * rng.uniform(0.5, 1.3)
        rows.append((1000 + k, (base[k] + noise).astype(np.float32).tolist(), int(k % 3)))
    rows += [(2000 + k, base[5].tolist(), 5 % 3) for k in range(50)] + [(3000, base[5].tolist(), 1), (3001, base[5].tolist(), None)]
    got = {r.vec_id: r for r in lattice.dedup(vectors(spark, rows + ODD), 0.93).collect()}
    assert len(got) == len(rows) + len(ODD)
    ids, v, label = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64), np.array([-k if r[2] is None else r[2] for k, r in enumerate(rows)])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    true = linked.sum(1)
    found = np.array([got[i].n_links for i in ids.tolist()])
    assert (found <= true).all() and found.sum() >= 0.97 * true.sum()
    assert got[2049].n_links >= 50 and got[2049].component_id == 5 and not got[2049].kept
    assert got[3001].n_links == 0 and got[3001].kept
    assert all(got[i].n_links == 0 and got[i].component_id == i for i, *_ in ODD[:6])
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert lattice.dedup(vectors(spark, []), 0.93).count() == 0


@pytest.mark.parametrize("cosine", [0.93, 0.95])
def test_lattice_recall_over_large_planted_groups(spark, cosine, monkeypatch):
    from docketry.llm import lattice

    monkeypatch.setattr(lattice, "STORED", 64)  # groups of several blocks
    rng = np.random.default_rng(int(cosine * 100))
    rows = sample(3000, seed=11)
    # around each of 6 centres 300 vectors whose cosines with each other lie around the one asked for
    spread = np.sqrt((1 - cosine) / cosine)
    noise = rng.normal(size=(6, 300, 64))
    noise *= spread / np.linalg.norm(noise, axis=2, keepdims=True)
    groups = (sample(6, seed=12)[:, None, :] + noise).reshape(-1, 64).astype(np.float32)
    every = np.concatenate([rows, groups])
    got = {r.vec_id: r for r in lattice.dedup(vectors(spark, [(k, v.tolist(), int(k % 2 if k < 3000 else 0)) for k, v in enumerate(every)]), 0.93).collect()}
    label = np.array([k % 2 if k < 3000 else 0 for k in range(len(every))])
    unit = every.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    true = linked.sum(1)
    found = np.array([got[k].n_links for k in range(len(every))])
    assert (found <= true).all() and true.sum() > 100_000
    recall = found.sum() / true.sum()
    print(f"recall at cosines around {cosine}: {recall:.4f} of {true.sum() // 2} links")
    assert recall >= 0.9


def calls(*items, content=None):
    return json.dumps({"content": content, "tool_calls": [{"id": i, "name": n, "arguments": a, "depends_on": d} for i, n, a, d in items]})


def test_chat_links_orders_and_validates(spark):
    from docketry.llm import chat

    rows = [
        (1, 0, "user", "hi \"there\"\n"),
        (1, 1, "assistant", calls(("a", "search", {"query": "x", "limit": 3}, []), ("b", "fetch", {"url": 5}, []), content="ok")),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": {"z": 1, "b": [2]}})),
        (1, 3, "tool", json.dumps({"tool_call_id": "zz", "content": "?"})),
        (1, 4, "assistant", calls(("c", "calculate", json.dumps({"expression": "1+1"}), ["a"]), ("a", "search", {"query": "y"}, []))),
        (1, 5, "tool", json.dumps({"tool_call_id": "c", "content": "2"})),
        (2, 0, "tool", json.dumps({"tool_call_id": "k", "content": "early"})),
        (2, 1, "assistant", calls(("k", "nosuch", {}, []))),
        (3, 0, "assistant", calls(("p", "fetch", {"url": "u"}, ["q"]), ("q", "fetch", {"url": "u"}, ["p"]))),
        (4, 0, None, None),
        (None, 1, "user", "{bad json"),
        (5, 0, "assistant", '{"tool_calls": 5}'),
    ]
    messages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, status string, place int")
    got = chat.format_chats(messages).orderBy("conv_id", "place", "level", "turn", "item").collect()
    status = {(r.conv_id, r.turn, r.call_id, r.kind): r.status for r in got if r.kind != "message"}
    assert status == {
        (1, 1, "a", "call"): "ok", (1, 1, "b", "call"): "invalid_arguments", (1, 2, "a", "result"): "ok", (1, 3, "zz", "result"): "orphan", (1, 4, "c", "call"): "ok",
        (1, 4, "a", "call"): "duplicate", (1, 5, "c", "result"): "ok", (2, 1, "k", "call"): "unknown_tool", (2, 0, "k", "result"): "ok", (3, 0, "p", "call"): "cyclic", (3, 0, "q", "call"): "cyclic",
    }
    order = [(r.kind, r.call_id) for r in got if r.conv_id == 1]
    assert order.index(("call", "a")) < order.index(("result", "a")) < order.index(("call", "c")) < order.index(("result", "c"))
    order = [(r.kind, r.call_id) for r in got if r.conv_id == 2]
    assert order.index(("call", "k")) < order.index(("result", "k"))
    for r in got:
        assert r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert next(r.json for r in got if r.call_id == "a" and r.kind == "call") == '{"arguments":{"limit":3,"query":"x"},"id":"a","name":"search"}'
    assert chat.format_chats(messages.limit(0)).count() == 0


def test_long_chains_of_calls_are_placed(spark):
    from docketry.llm import chat

    n = 6
    ids = list(range(n))
    random.Random(0).shuffle(ids)
    rows = []
    for t, k in enumerate(ids):
        rows.append((1, 2 * t, "assistant", calls((f"c{k}", "fetch", {"url": "u"}, [f"c{k - 1}"] if k else []))))
        rows.append((1, 2 * t + 1, "tool", json.dumps({"tool_call_id": f"c{k}", "content": k})))
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).filter("kind <> 'message'").orderBy("place", "level", "turn", "item").collect()
    assert [(r.kind, r.call_id) for r in got] == [(kind, f"c{k}") for k in range(n) for kind in ("call", "result")]


def test_components_of_chains_and_stars(spark):
    from docketry.llm.shared import components

    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 200)] + [(500, 500)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 200)}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


@pytest.mark.parametrize("name", ["op3_chat_formatting", "op7_topk", "op8_line_dedup", "op10_mixing"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from docketry.llm.queries import QUERIES, SQL

    base = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{base}/{t}.parquet'")
    frame = QUERIES[name](spark, base)
    want = con.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(map(repr, (tuple(r) for r in frame.select(names).collect()))) == sorted(map(repr, want.fetchall()))
