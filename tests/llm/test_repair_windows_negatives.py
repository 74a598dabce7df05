"""Window dedup, conversation repair and hard negatives against brute force on awkward rows; the catalogue's SQL on sf0.001."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from conftest import SF
from factline.llm import negatives, queries, repair, windows

SPACES = " \t\n\x0b\x0c\r"


def stored(spark, tmp_path_factory, rows, schema, parts=3):
    path = str(tmp_path_factory.mktemp("rows") / "t")
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- the catalogue

@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    rel = con.sql(queries.oracle_sql()[name])
    at = [rel.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


# ---------------------------------------------------------------- windows

DOCS = "doc_id long, text string, bucket int, words long, block long, n_words string"


def document_rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)] + ["é", "ß", "A", "a", " x"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, texts = say(60), [say(rng.randint(0, 60)) for _ in range(20)]
    texts += [f"{say(9)} {passage}\t{say(5)}" for _ in range(6)] + [passage, passage.replace(" ", "\n"), f"{say(3)} {passage[:120]}"]
    texts += [None, "", " \t", "x " * 12, "x " * 13, "x " * 50, "x " * 14, " ".join(["a b"] * 30), say(40_000)]
    texts += [texts[-1][1000:90_000]]
    rows = [(7 * k % 101, t) for k, t in enumerate(texts)]
    rows += [(None, passage), (None, passage), rows[3], rows[3], (-4, texts[2])]
    return [(i, t, 1, None, 3, "c") for i, t in rows]


def brute_windows(rows, width):
    first, split = {}, []
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        split.append((math.inf if i is None else i, i, w))
        for j in range(len(w) - width + 1):
            g = tuple(w[j:j + width])
            first[g] = min(first.get(g, math.inf), split[-1][0])
    out = Counter()
    for k, i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if first[tuple(w[j:j + width])] < k:
                gone[j:j + width] = [True] * width
        spans = [(g[0][0], g[-1][0] + 1) for r, g in ((r, list(g)) for r, g in itertools.groupby(enumerate(gone), key=lambda x: x[1])) if r]
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[(i, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), tuple(spans), kept.decode())] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"block_bytes": 2000, "bits": 32}, {"width": 1}, {"width": 5, "block_bytes": 1}])
def test_window_dedup(spark, tmp_path_factory, options):
    docs = stored(spark, tmp_path_factory, document_rows(), DOCS)
    got = windows.window_dedup(docs, with_text=True, **options).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], tuple((s["begin"], s["end"]) for s in r["spans"]), r["kept_text"]) for r in got)
    assert got == brute_windows(document_rows(), options.get("width", 13))


def test_window_dedup_empty(spark, tmp_path_factory):
    assert windows.window_dedup(stored(spark, tmp_path_factory, [], DOCS)).count() == 0


@pytest.mark.parametrize("width", [1, 2, 3, 7, 8, 13])
def test_rolling_equals_polynomial(width):
    digits = np.random.default_rng(3).integers(0, 2**63, 40).astype(np.uint64)
    want = [sum(int(d) * pow(5, width - 1 - k) for k, d in enumerate(digits[i:i + width])) % 2**64 for i in range(40 - width + 1)]
    assert windows.rolling(digits, width, 5).tolist() == want


def test_windows_that_share_a_short_hash_part():
    """Bits of a bucket's answers stand in the order sent; chance hits of the short hash change nothing."""
    entries = windows.pack_entries(np.array([3, 3, 9], np.uint64), np.array([1, 2, 1], np.uint64), np.array([5, 6, 7]))
    assert [x.tolist() for x in windows.unpack_entries(*entries)] == [[3, 3, 9], [1, 2, 1], [5, 6, 7]]
    import pandas as pd
    other = windows.pack_entries(np.array([3, 9], np.uint64), np.array([2, 4], np.uint64), np.array([1, 1]))
    frame = pd.DataFrame([(0, 10, *entries), (0, 11, *other)], columns=["bucket", "block", "payload", "second", "docs"])
    answer = windows.smaller_elsewhere(frame)
    assert answer["block"].tolist() == [10] and np.unpackbits(np.frombuffer(answer["answer"][0], np.uint8), count=3).tolist() == [0, 1, 0]


# ---------------------------------------------------------------- conversations

TURNS = "conv_id long, turn long, role string, text string, seg long, state string, n int"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        s = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        role, text = s(role), s(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows, faults):
    """(cost, audit, repaired) by a forward search over all edits, ties by the audit so far."""
    def put(best, state, way):
        if state is not None and (state not in best or way[:2] < best[state][:2]):
            best[state] = way
            return True
        return False

    def inserted(best):
        while any([put(best, STEPS[st].get(r[0]), (c + 5, a + "I", out + ((r, ""),))) for st, (c, a, out) in list(best.items()) for r in ("user", "assistant")]):
            pass
        return best

    best = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults):
        new = {}
        for st, (c, a, out) in inserted(best).items():
            put(new, st, (c + 2, a + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            put(new, STEPS[st].get(role[:1]), (c + more, a + "K", out + ((role, text),)))
            for r in ("user", "assistant"):
                put(new, STEPS[st].get(r[0]), (c + 1 + more, a + "R", out + ((r, text),)))
        best = new
    best = inserted(best) if rows else best
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def brute_report(rows):
    by = defaultdict(list)
    for r in damaged(rows):
        by[r[0]].append(r)
    out = []
    for conv in {r[0] for r in rows}:
        rs = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
        turns, seen, faults = [r[1] for r in rs if r[1] is not None], set(), []
        for _, _, role, text in rs:
            body = text.strip(SPACES)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, repaired = cheapest(rs, faults)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        n = Counter(faults)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()))
    return sorted(out, key=repr)


def turn_rows():
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "unknown"], ["Hi.", "ok", "", "Yes!  \n", None, "no\t", "What?", "é. " * 3000, " x. y"]
    rows = []
    for i in range(120):
        for t in range(rng.randint(1, 12)):
            turn = rng.choice([t, t, rng.randint(0, 5), None]) if i % 3 == 0 else t
            rows.append((i, turn, rng.choice(roles) if i % 2 else rng.choice(roles[:2]), rng.choice(texts)))
    # a hot conversation: long runs, repeated rows, a truncated stretch
    rows += [(-7, t, rng.choice(["user", "assistant"]) if t % 700 < 300 else "user", f"text {t}." if t % 5 else "tr") for t in range(2500)]
    rows += [(None, rng.choice([1, 2, None, 4]), "user", "a. b") for _ in range(40)] + rows[:5]
    return rows


@pytest.mark.parametrize("size", [1 << 16, 7])
def test_conversation_report(spark, tmp_path_factory, size):
    table = stored(spark, tmp_path_factory, [(*r, 1, "x", None) for r in turn_rows()], TURNS)
    assert sorted(map(tuple, repair.report(table, rows_per_segment=size).collect()), key=repr) == brute_report(turn_rows())


def test_conversation_empty_and_dropped(spark, tmp_path_factory):
    assert repair.report(stored(spark, tmp_path_factory, [], TURNS)).count() == 0
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = repair.report(stored(spark, tmp_path_factory, [(gone, 0, "user", "Hi.", 0, "", 0)], TURNS)).collect()
    assert list(map(tuple, got)) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_repaired_rows_hold_the_grammar(spark, tmp_path_factory):
    import re
    table = stored(spark, tmp_path_factory, [(*r, 1, "x", None) for r in turn_rows()], TURNS)
    rows = repair.damage(table)
    steps = repair.repaired_rows(rows, repair.repair(rows, 50)).collect()
    by = defaultdict(list)
    for r in sorted(steps, key=lambda r: r["place"]):
        by[r["conv"]].append(r)
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in rs)) for rs in by.values())
    assert all([r["place"] for r in rs] == list(range(len(rs))) for rs in by.values())


def test_powers_equal_rows_one_by_one():
    rng = random.Random(5)
    for _ in range(200):
        symbols = np.repeat([rng.randrange(12) for _ in range(rng.randint(1, 4))], rng.randint(1, 37))
        state, costs = rng.randrange(4), repair.END
        runs = repair.collapse(symbols)
        singles = [(int(s), 1) for s in symbols]
        assert repair.unroll(runs, state, costs) == repair.unroll(singles, state, costs)
        assert repair.segment_matrix(runs) == repair.segment_matrix(singles)


# ---------------------------------------------------------------- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, rank int, block int, score string"


def vector_rows():
    rng = random.Random(1)
    rows = []
    for i in range(500):
        v = [rng.choice([rng.gauss(0, 1), 0.5, 1.0]) for _ in range(3)]
        rows.append((i * 5 if i % 3 else i * 100, v, rng.choice([0, 1, 2, None] if i % 5 == 0 else [0, 1, 2])))
    rows += [(100, None, 1), (200, [1.0, None, 2.0], 1), (300, [math.nan, 1.0, 1.0], 1), (400, [math.inf] * 3, 1), (None, [1.0, 1.0, 1.0], 2)]
    rows += [(500, [], 1), (600, [2.0], 1), (700, [1.0, 1.0, 1.0, 9.0], 2), (None, None, None)]
    return rows + [rows[3]] * 3 + [(5000, [1.0, 1.0, 1.0], 0)] * 30


def brute_negatives(rows):
    last = 1 << 62
    ok = [(last if i is None else i, i, [math.floor(256 * float(np.float32(x))) for x in v], (y + 1) % 10 if i is not None and i % 7 == 0 else y)
          for i, v, y in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (_, i, q, y) in enumerate(ok):
        if i is None or i % 100:
            continue
        s = [sum(x * z for x, z in zip(o[2], q)) for o in ok]
        order = sorted(range(len(ok)), key=lambda b: (-s[b], ok[b][0]))
        for p in [b for b in order if b != a and ok[b][3] == y][:5]:
            hard = [b for b in order if ok[b][3] != y and 30 * s[p] <= 100 * s[b] <= 90 * s[p]][:10]
            out += [(i, ok[p][1], r, ok[b][1], s[p], s[b]) for r, b in enumerate(hard, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"block_rows": 60, "batch_rows": 50, "pivots": 4}])
def test_hard_negatives(spark, tmp_path_factory, options):
    table = stored(spark, tmp_path_factory, [(*r, 1, 2, "x") for r in vector_rows()], VECTORS)
    assert sorted(map(tuple, negatives.mine(table, **options).collect()), key=repr) == brute_negatives(vector_rows())


def test_hard_negatives_empty(spark, tmp_path_factory):
    for rows in ([], [(100, None, 1, 1, 1, "")], [(1, [1.0], 1, 1, 1, "")], [(100, [1.0], 1, 1, 1, "")]):
        assert negatives.mine(stored(spark, tmp_path_factory, rows, VECTORS, 1)).count() == 0


def test_cover_tree_covers_and_skips():
    rng = np.random.default_rng(2)
    centers = rng.integers(-3000, 3000, (12, 6))
    vectors = (centers[rng.integers(0, 12, 3000)] + rng.integers(-20, 20, (3000, 6))).astype(float)
    tree = negatives.CoverTree.build(vectors)
    assert sorted(tree.order.tolist()) == list(range(3000)) and (tree.vectors == vectors[tree.order]).all()
    rest = np.sqrt(tree.top - tree.squares)
    points = np.column_stack([tree.vectors, rest])
    for (center, _, _, begin, end), radius in zip(tree.nodes, tree.radius):
        assert np.linalg.norm(points[begin:end] - points[center], axis=1).max() <= radius + 1e-3
    search = negatives.Search(tree, centers[0].astype(float))
    best = search.best(5, np.ones(3000, bool), np.arange(3000))
    scores = (tree.vectors @ centers[0]).astype(np.int64)
    assert scores[best].tolist() == sorted(scores.tolist(), reverse=True)[:5]
    assert search.known.sum() < (tree.nodes[:, 2] == 0).sum() / 2  # clustered rows: most leaves are never scored


def test_large_components_are_exact():
    tree = negatives.CoverTree.build(np.array([[2.0**26, 1.0], [2.0**26, 3.0], [-(2.0**26), 0.0]]))
    search = negatives.Search(tree, np.array([2.0**26, 1.0]))
    best = search.best(2, np.ones(3, bool), np.arange(3))
    assert search.scores[best].tolist() == [2**52 + 3, 2**52 + 1]
