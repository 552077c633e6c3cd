"""Periodic runs, source mixing and the Merkle manifest against plain versions, and the cases each must define."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- periodic runs --------------------------------------------------------------------------

def plain_runs(ws, exponent=4, min_length=6):
    """Every stretch at every lag, longest first by definition: maximal, smallest period."""
    n, best = len(ws), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and ws[i] == ws[i + q]:
                i += 1
            if i - s + q >= max(min_length, exponent * q):
                best.setdefault((s, i - s + q), q)
    return sorted((s, length, q) for (s, length), q in best.items())


def plain_loop(ws, number):
    n = len(ws)
    if number is None or not n or number % 10:
        return ws
    g = number // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def run_texts(seed=5):
    rnd = random.Random(seed)
    texts = []
    for k in range(120):
        vocab = [f"w{i}" for i in range(rnd.choice([1, 2, 3, 30]))]
        parts = []
        for _ in range(rnd.randint(0, 4)):
            parts += [rnd.choice(vocab) for _ in range(rnd.randint(0, 30))]
            if rnd.random() < 0.7:
                unit = [rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 5, 15, 16, 17, 18, 24, 25, 36, 37, 80, 121, 122]))]
                times = rnd.choice([3, 4, 4, 5, 7])
                parts += (unit * (times + 1))[:len(unit) * times + rnd.randint(-1, len(unit) - 1)]
        texts.append(rnd.choice([" ", "\n", "\t "]).join(parts))
    unit = [f"u{i}" for i in range(400)]
    return texts + [None, "", " \n", "a", "a " * 5, "a " * 6, "É 漢 É 漢 É 漢 É 漢", texts[3], texts[3],
                    " ".join(unit * 4), " ".join((unit * 4)[:-1]), " ".join(f"v{i}" for i in range(40_000)) + " z" * 5000]


def test_runs_equal_brute_force(spark):
    from tidewell.llm.dataset_queries import id_number
    from tidewell.llm.periodic_runs import periodic_runs
    texts = run_texts()
    ids = [None if i == 7 else i for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "x", 1, "r") for i, t in zip(ids, texts)],
                                 "doc_id long, text string, runs string, loop int, n_words string").repartition(3)
    got = sorted(map(tuple, periodic_runs(docs, loop=id_number()).select(
        F.coalesce("doc_id", F.lit(-1)), "n_words", "runs", "best", "collapsed_text").collect()), key=str)
    want = []
    for i, t in zip(ids, texts):
        ws = words(t)
        ws = plain_loop(ws, None if i is None else zlib.crc32(str(i).encode()))
        # lags beyond the planted ones cannot repeat in the long text of distinct words
        runs = plain_runs(ws) if len(ws) < 5000 else [(40_000, 5000, 1)] if i is None or zlib.crc32(str(i).encode()) % 10 else None
        if runs is None:
            runs = plain_runs_fast(ws)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
        want.append((-1 if i is None else i, len(ws), runs, best, " ".join(w for k, w in enumerate(ws) if k not in gone)))
    want.sort(key=str)
    for g, w in zip(got, want):
        assert (g[0], g[1], [tuple(r) for r in g[2]], tuple(g[3]) if g[3] else None, g[4]) == w
    assert len(got) == len(want) and sum(len(w[2]) for w in want) > 100


def plain_runs_fast(ws):
    """The same by whole-array comparison, for one long text."""
    _, a = np.unique(np.array(ws), return_inverse=True)
    best = {}
    for q in range(1, len(a) // 4 + 1):
        same = np.r_[0, (a[q:] == a[:-q]).astype(np.int8), 0]
        edge = np.flatnonzero(np.diff(same))
        for s, z in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if z - s + q >= max(6, 4 * q):
                best.setdefault((s, z - s + q), q)
    return sorted((s, n, q) for (s, n), q in best.items())


def test_runs_at_every_scale():
    from tidewell.llm.periodic_runs import find_runs
    rnd = np.random.default_rng(1)
    for q in [*range(1, 140), 181, 182, 272, 273, 500]:
        unit = rnd.integers(0, 2**63, q, dtype=np.uint64)
        for length in {max(6, 4 * q), 4 * q + 1, 4 * q - 1, 5 * q + q // 2}:
            a, b = rnd.integers(0, 2**63, 37, dtype=np.uint64), rnd.integers(0, 2**63, 29, dtype=np.uint64)
            text = np.concatenate([a, np.resize(unit, length), b])
            first = np.array([0, len(text), len(text), len(text) + 3])
            got = find_runs(np.concatenate([text, text[:3]]), first)
            want = [(37, length, q)] if length >= max(6, 4 * q) else []
            assert list(zip(*(x.tolist() for x in got))) == want, (q, length)


def test_runs_of_an_empty_table(spark):
    from tidewell.llm.periodic_runs import periodic_runs
    assert periodic_runs(spark.createDataFrame([], "doc_id string, text string")).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(spark.createDataFrame([], "doc_id string, text string"), exponent=3)


# ---- mixing ---------------------------------------------------------------------------------

def test_flow_is_the_cheapest():
    from tidewell.llm.mixing import min_cost_flow
    rnd = random.Random(2)
    for _ in range(60):
        n_sources, copies = rnd.randint(1, 3), 2
        members = [sorted(rnd.sample(range(n_sources), rnd.randint(1, n_sources))) for _ in range(rnd.randint(1, 3))]
        tokens = [rnd.randint(0, 3) for _ in members]
        quotas = [rnd.randint(0, 4) for _ in range(n_sources)]
        flow = min_cost_flow(tokens, members, quotas, copies)
        given = [sum(f) for f in flow]
        taken = [sum(f[own.index(s)] for f, own in zip(flow, members) if s in own) for s in range(n_sources)]
        assert all(g <= copies * t for g, t in zip(given, tokens)) and all(a <= q for a, q in zip(taken, quotas))

        def cost(g, t):
            return g if g <= t else t + 2 * (g - t)
        arcs = [(p, s) for p, own in enumerate(members) for s in own]
        best = None
        for x in itertools.product(*(range(min(copies * tokens[p], quotas[s]) + 1) for p, s in arcs)):
            gp = [sum(v for v, (p, _) in zip(x, arcs) if p == k) for k in range(len(members))]
            ts = [sum(v for v, (_, s) in zip(x, arcs) if s == k) for k in range(n_sources)]
            if all(g <= copies * t for g, t in zip(gp, tokens)) and all(a <= q for a, q in zip(ts, quotas)):
                best = min(best or (1, 0), (-sum(x), sum(map(cost, gp, tokens))))
        assert (-sum(given), sum(map(cost, given, tokens))) == best


def plain_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        room = sum(w[s] for s in names if s not in full)
        new = {s for s in names if s not in full and left * w[s] / room > 2 * sizes[s]} if room else set()
        if not new:
            return {s: 2.0 * sizes[s] if s in full else left * w[s] / room for s in names}
        full |= new


def test_mix_meets_targets(spark, tmp_path):
    from tidewell.llm.dataset_queries import op12_mix_sources
    rnd = random.Random(4)
    rows = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "é", "z", None, "tiny" if i % 40 == 1 else "b"])
        rows.append((i if i % 50 else None, None if i % 97 == 0 else " ".join(["w"] * (5000 if i % 300 == 5 else rnd.randint(0, 40))),
                     source, "s", 1.0))
    rows += [rows[7]] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, seed string, target double")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_mix_sources(spark, str(tmp_path))
    sources = sorted(map(tuple, got.groupBy("target", "source_size").agg(F.sum("taken"), F.sum("size")).collect()))
    sizes = {}
    for _, t, s, _, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    targets = plain_targets(sizes)
    assert sorted((t, sizes[s]) for s, t in targets.items()) == [(pytest.approx(x[0]), x[1]) for x in sources]
    for target, size, taken, own in sources:
        assert own == size and 0 <= target - taken < 50
    out = sorted(map(str, got.collect()))
    assert len(out) == len(rows) and out == sorted(map(str, op12_mix_sources(spark, str(tmp_path)).collect()))
    assert got.where("taken > 2 * size OR taken % greatest(size, 1) <> 0").isEmpty()


def test_mix_of_overlapping_sources(spark):
    from tidewell.llm.mixing import mix_sources
    rnd = random.Random(6)
    rows = [(i, rnd.choice([["a"], ["b"], ["a", "b"], ["b", "c", "c"], ["d"], [], None]), rnd.randint(1, 9), f"{rnd.random()}", "x")
            for i in range(600)]
    sized = spark.createDataFrame(rows, "doc_id long, members array<string>, size long, seed string, position string")
    out, targets = mix_sources(sized)
    targets = {r["source"]: (r["source_size"], r["target"]) for r in targets.collect()}
    for s, (size, target) in targets.items():
        assert size == sum(n for _, m, n, _, _ in rows if s in (m or [])) and target <= 2 * size
    got = out.collect()
    assert len(got) == len(rows) and all(r["copies"] == 0 for r in got if not r["members"]) and max(r["copies"] for r in got) <= 2
    # every quota can be met here, so the patterns together give the sum of the quotas, a word or two each less
    assert 0 <= sum(int(t) for _, t in targets.values()) - sum(r["copies"] * r["size"] for r in got) <= 60


def test_mix_of_an_empty_table(spark, tmp_path):
    from tidewell.llm.dataset_queries import op12_mix_sources
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op12_mix_sources(spark, str(tmp_path)).collect() == []


# ---- Merkle manifest ------------------------------------------------------------------------

def plain_tree(leaves):
    """(root, list of (left, right) siblings bottom-up for each leaf)."""
    proofs, nodes, own = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        up, up_own = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i:i + 3]
            for k in range(len(run)):
                for leaf in own[i + k]:
                    proofs[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(sha("".join(run)))
            up_own.append(sum(own[i:i + 3], []))
        nodes, own = up, up_own
    return nodes[0], proofs


def plain_manifest(rows):
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [plain_tree([leaf(r) for r in groups[s]]) for s in order]
    root, above = plain_tree([t[0] for t in trees])
    out = []
    for s, (subroot, proofs), upper in zip(order, trees, above):
        for r, proof in zip(groups[s], proofs):
            path, other = proof + upper, list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                other[4] = r[4].replace("\n", "")
            top = leaf(other)
            for left, right in path:
                top = sha(left + top + right)
            out.append((r[0], leaf(r), subroot, root, sha("".join(a + b for a, b in path)), top, top == root))
    return sorted(out, key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string, grp string, leaf int, rank string"


@pytest.mark.parametrize("case", ["many", "one row", "one each"])
def test_manifest_equals_plain_trees(spark, tmp_path, case):
    from tidewell.llm.dataset_queries import op13_merkle_manifest
    rnd = random.Random(8)
    if case == "many":
        rows = [(i, "hot" if i % 3 else rnd.choice(["é", "z", None, "1", "0"]), rnd.choice(["en", None]), i * 7 if i % 5 else None,
                 rnd.choice([f"line {i}\nnext", f"plain {i}", None, "", "é\n" * 3])) for i in range(2500)]
        rows += [(None, "hot", "en", 1, "n"), (None, None, None, None, None), (9_999, "big", "en", 1, "\n" + "long " * 300_000)]
        rows += [(5000, "hot", "en", 1, "same")] * 1500 + [(6000, "lone", "x", 2, "a\nb")] + [(1, "hot", "de", 0, "other text")]
    else:
        rows = [(i, f"s{i}", "en", 3, "a\nb") for i in range(1 if case == "one row" else 11)]
    docs = spark.createDataFrame([(*r, "g", 1, "r") for r in rows], DOCS)
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op13_merkle_manifest(spark, str(tmp_path)).collect()), key=str)
    want = plain_manifest(rows)
    assert got == want
    if case == "many":
        assert {w[-1] for w in want} == {True, False}


def test_manifest_siblings_and_empty_table(spark):
    from tidewell.llm.merkle import merkle_manifest
    docs = spark.createDataFrame([(f"k{i}", "g", "t") for i in range(5)], "key string, grp string, text string")
    out = merkle_manifest(docs, ["key", "text"], "key", "grp", with_siblings=True).collect()
    for r in out:
        assert sha("".join(r["siblings"])) == r["proof_sha256"] and r["verified"] and r["subroot"] == r["root"]
    assert sorted(len(r["siblings"]) for r in out) == [2] * 5
    assert merkle_manifest(docs.limit(0), ["key", "text"], "key", "grp").collect() == []
