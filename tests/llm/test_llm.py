"""The training-data operators on small tables with awkward rows, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from factline.llm import components, decontam, exact, langid, lines, lm, mixing, quality, simhash, suffix, tokens
from factline.llm.common import cut

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row long, name string, h long, n long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau upsilon phi chi psi omega".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def rows():
    rng = random.Random(7)
    shared = sentence(rng, 30)
    out = [sentence(rng, rng.randint(1, 120)) for _ in range(30)]
    out += [sentence(rng, 10) + "\n" + shared + "\n" + sentence(rng, 12) for _ in range(8)]
    out += [shared] * 3 + [None, "", "", " \t\n", "ß" * 60, "A b\tC", "abC", "12 !!", "x" * 3000, "é " * 700]
    out += ["\n".join([sentence(random.Random(5), 9)] * 3)] * 6
    data = [(i * 3, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2", None]), 1, 5, "n", 6, 7) for i, t in enumerate(out)]
    return data + [(None, shared, None, None, None, None, None, None, None), data[0], data[0], (-5, out[1], "en", "s1", 1, 1, "", 1, 1)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def key(x):
    return (x is None, x if x is not None else 0)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("hash_bits,block", [(64, 4096), (3, 16)])
def test_exact_dedup(docs, hash_bits, block):
    squeezed = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = defaultdict(list)
    for r in rows():
        groups[squeezed(r[1])].append((-len(r[1] or ""), key(r[0])))
    want = Counter()
    for s, members in groups.items():
        members.sort()
        for i, (_, k) in enumerate(members):
            want[(None if k[0] else k[1], None if members[0][1][0] else members[0][1][1], len(members), i == 0, hashlib.sha256(s.encode()).hexdigest())] += 1
    got = exact.exact_dedup(docs, block_size=block, hash_bits=hash_bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert Counter(tuple(r) for r in got.collect()) == want


def brute_lines(min_docs):
    strip = " \t\n\x0b\x0c\r"
    fold = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(strip))
    holders = defaultdict(set)
    for r in rows():
        for line in (r[1] or "").split("\n"):
            if len(fold(line)) >= 40:
                holders[fold(line)].add(r[0])
    keeper = {k: max(v, key=lambda x: (x is not None, x or 0)) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for r in rows():
        parts = (r[1] or "").split("\n")
        kept = [x for x in parts if not (fold(x) in keeper and keeper[fold(x)] != r[0])]
        out.append((r[0], len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "salts": 3}, {"broadcast_bytes": 0, "salts": 2, "keys_per_shard": 1}])
def test_line_dedup(docs, options):
    want = brute_lines(3)
    assert sum(r[2] for r in want) > 5
    assert collected(lines.line_dedup(docs, min_docs=3, with_text=True, **options)) == want


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(-2**62, 2**62, 5000))
    h = lines.PerfectHash.build(keys)
    assert sorted(h.index(keys)) == list(range(len(keys)))
    shard = lines.Shard.unpack(lines.Shard.build(np.concatenate([keys, keys[:3]]), np.arange(len(keys) + 3), np.ones(len(keys) + 3, np.int64), np.arange(len(keys) + 3)).pack())
    known, keeper = shard.probe(np.concatenate([keys, keys[:3], keys[:1]]), np.concatenate([np.arange(len(keys) + 3), [-1]]))
    assert known[:-1].all() and not known[-1] and (keeper[:-1] == np.arange(len(keys) + 3)).all()
    assert not shard.probe(rng.integers(2**62, 2**63 - 1, 100), np.zeros(100, np.int64))[0].any()


def test_lm_scoring(docs):
    got = lm.score(docs, frequent=20).collect()
    learned, texts = Counter(), []
    for r in rows():
        words = (r[1] or "").encode().lower().split() + [b""]
        apart = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0
        texts.append((r[0], apart, words))
        if not apart:
            learned.update(words)
    n, v = sum(learned.values()), len(learned)
    want = sorted(((d, a, len(w), sum(learned[x] > 0 for x in w), n, round(sum(math.log10((learned[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)) for d, a, w in texts), key=repr)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == want
    assert all(r.score < 0 for r in got)


def test_lm_parts_count_like_one():
    """The whole-token tables of all parts hold the counts that one part of all words would hold."""
    rng = np.random.default_rng(5)
    words = sorted({bytes(rng.integers(97, 100, rng.integers(0, 9)).astype(np.uint8)) for _ in range(600)})
    c, k = rng.integers(0, 6, len(words)), rng.integers(0, 3, len(words))
    code = lm.Code(np.bincount(np.frombuffer(b" ".join(words), np.uint8), minlength=256))
    seen = lambda b, x: {i: b.hashed(i, x) for i in lm.WHOLE}
    want: dict = {i: Counter() for i in lm.WHOLE}
    for group, tokens in lm._groups(words):
        b = lm.Bits(tokens, code, lm.WHOLE)
        for i, x in seen(b, k[group]).items():
            for slot, bit, w in zip(x.tolist(), b.bit.tolist(), c[group][b.token].tolist()):
                want[i][slot, bit] += w
    cuts = [0, 40, 41, 150, 260, len(words)]
    parts = [lm.Part(words[a], words[z - 1], words[a - 1] if a else None, words[z] if z < len(words) else None) for a, z in zip(cuts, cuts[1:])]
    shared: dict = {i: Counter() for i in lm.WHOLE}
    for part, a, z in zip(parts, cuts, cuts[1:]):
        depths, heads = part.heads(words[a:z])
        for w, d, head in zip(words[a:z], depths, heads):
            # exactly the beginnings that other parts have
            assert all(any(v.startswith(w[:n]) for v in words[:a] + words[z:]) == (n <= d) for n in range(min(len(w), 20) + 1))
        b = lm.Bits(heads, code, lm.WHOLE)
        here = b.place_of_byte[b.byte] <= depths[b.token]
        for i, x in seen(b, k[a:z]).items():
            for slot, bit, w in zip(x[here].tolist(), b.bit[here].tolist(), c[a:z][b.token][here].tolist()):
                shared[i][slot, bit] += w
    spanning = {}
    for i in lm.WHOLE:
        x = np.unique(np.array([s for s, _ in shared[i]], np.uint32))
        spanning[i] = x, np.array([[shared[i][s, 0], shared[i][s, 1]] for s in x.tolist()], float).reshape(-1, 2)
    for part, a, z in zip(parts, cuts, cuts[1:]):
        got = lm.whole_tables(words[a:z], c[a:z], k[a:z], part, spanning, code, 3)
        b = lm.Bits(words[a:z], code, lm.WHOLE)
        for i in lm.WHOLE:
            # the contexts of the part's learned words, and the shared ones in every class
            inside = b.place_of_byte[b.byte] <= part.heads(words[a:z])[0][b.token]
            asked = set(b.hashed(i, k[a:z])[c[a:z][b.token] > 0].tolist()) | {x for j in range(3) for x in b.hashed(i, j)[inside].tolist()}
            exact = np.zeros((len(got[i]), 2))
            for x in asked:
                exact[x >> (33 - len(got[i]).bit_length())] += want[i][x, 0], want[i][x, 1]
            np.testing.assert_array_equal(got[i], lm.states(exact))


def test_lm_scores_in_many_parts(spark, docs):
    """However many parts the words are dealt to, a model with the same weights scores alike, but for slots that contexts share."""
    key = lambda r: (r.doc_id is None, r.doc_id, r.base_score)
    one, many = (sorted(lm.score(docs, part_bytes=n, passes=0, slots_per_bit=200).collect(), key=key) for n in (1 << 20, 300))
    learned, again = (sorted(lm.score(docs, part_bytes=300).collect(), key=key) for _ in range(2))
    assert [r[:6] for r in one] == [r[:6] for r in many] == [r[:6] for r in learned]
    assert learned == again and [r.score for r in learned] != [r.score for r in many]
    assert all(abs(a.score - b.score) < 0.01 * abs(a.score) for a, b in zip(one, many))


def test_lm_beats_unigrams_and_sums_to_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = lm.score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.avg("bits_per_byte")).first()
    assert held[0] > held[1] and held[2] < 4
    # the code's bits have probabilities: those of all tokens of one or two bytes stay below one
    code = lm.Code(np.bincount(np.frombuffer(b"aab ab b " * 50, np.uint8), minlength=256))
    counts = [np.zeros((256, 2), np.float32) for _ in lm.PREDICTORS]
    import zstandard
    mixer = lm.Mixer(code, {i: zstandard.compress(lm.states(c).tobytes()) for i, c in enumerate(counts)})
    words = [b""] + [bytes([x]) for x in range(256) if x != 32]
    p = 10 ** mixer.log10(words, 1)[:, 0]
    assert abs(code.length[32] - -math.log2(p[0])) < 1e-3 and p.sum() < 1


def test_decontamination(spark, docs):
    items = [(1, "Tom bought 12 apples and 5 kg of fresh pears for his 3 sisters at the old market in Berlin today"),
             (2, "the quick brown fox jumps over the lazy dog while nobody watches from the tall tower"), (3, "short one"), (None, "a b c d e f g h i j"), (2, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [(1, items[0][1]), (2, "Well, Tom bought 7 apples and 9 kg of fresh pears for his 4 sisters at the old market in Paris today, he said."),
             (3, "Intro words. The QUICK brown fox, jumps over the lazy dog; while nobody watches from the tall tower!"), (4, "nothing here to see at all, move along please now"),
             (5, None), (6, ""), (7, "short one"), (None, items[1][1]),
             (8, "Tom bought 7 apples and 9 kg of fresh pears for his 4 sisters")]
    t = cut(spark.createDataFrame(texts, "doc_id long, text string"), "test-decontam")
    for limit in (10**6, 0):
        got = {r.doc_id: (r.contaminated, list(r.item_ids)) for r in decontam.decontaminate(t, bench, broadcast_windows=limit).collect()}
        assert got == {1: (True, [1]), 2: (True, [1]), 3: (True, [2]), 4: (False, []), 5: (False, []), 6: (False, []), 7: (False, []), None: (True, [2]), 8: (True, [1])}
    # one value of the item can't stand for two of the document
    twice = spark.createDataFrame([(1, "take 3 red balls and put them near 3 blue balls before you count 3 green balls again now")], "item_id long, text string")
    same = "take {} red balls and put them near {} blue balls before you count {} green balls again now"
    t = cut(spark.createDataFrame([(1, same.format(4, 4, 4)), (2, same.format(4, 5, 6))], "doc_id long, text string"), "test-decontam")
    assert {r.doc_id: r.contaminated for r in decontam.decontaminate(t, twice).collect()} == {1: True, 2: False}
    assert decontam.decontaminate(docs, bench).filter("contaminated").count() == 0
    assert decontam.clean_documents(docs, bench).columns == docs.columns


def found_items(spark, items, texts):
    t = cut(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "test-decontam")
    got = decontam.decontaminate(t, spark.createDataFrame(items, "item_id long, text string")).collect()
    return [list(r.item_ids) for r in sorted(got, key=lambda r: r.doc_id)]


def test_decontamination_names_in_any_place_and_case(spark):
    item = "Alice has 5 apples. Bob gives her 3 more apples. How many apples does Alice have?"
    market = "Tom bought 12 apples and 5 kg of fresh pears for his 3 sisters at the old market in Berlin where Eve O'Neil met Ann"
    other = "Carol has 9 apples. Dave gives her 4 more apples. How many apples does Carol have?"
    texts = [other, "so " + other.lower(), other.upper(), item.lower(), item.upper(), market.lower(), market.upper(), market.replace(" ", "\r\n"),
             market.replace(" ", "  "), market.replace("Berlin", "Rome").replace("O'Neil", "Smith"),
             other.replace("does Carol", "does Dave")]  # Alice can't be Carol and Dave at once
    assert found_items(spark, [(1, item), (2, market)], texts) == [[1]] * 5 + [[2]] * 5 + [[]]


def test_decontamination_dense_names(spark):
    item = "The friends Tom, Ann and Bob met Carl, Dora and Eve before Fred told Gina and Hal about Ida"
    other = "The friends Max, Sue and Jim met Kurt, Lena and Mia before Nils told Olga and Paul about Rita"
    assert found_items(spark, [(1, item)], [item, item.lower(), other, other.replace("told", "saw").replace("met", "left")])[:3] == [[1]] * 3


def test_decontamination_short_items(spark):
    items = [(1, "What is the capital city of France?"), (2, "12 + 7 * 31 - 45 / 2 + 8 - 64"), (3, "Where do wild bears sleep in the cold winter months?"),
             (4, "name two noble gases"), (5, "The farmer drove along the river until the tank held 5")]
    texts = ["Question: What is the capital city of France? Answer: Paris", "so what is the capital city of France", "compute 12 + 7 * 31 - 45 / 2 + 8 - 64 now",
             "compute 13 + 9 * 31 - 45 / 3 + 8 - 65 now", "Question: Where do wild bears sleep in the cold winter months?", "\nName two noble gases.",
             "name two noble men", "then the farmer drove along the river until the tank held 5 l of it", "What is the largest city of France?"]
    assert found_items(spark, items, texts) == [[1], [1], [2], [], [3], [4], [], [5], []]


def brute_suffix(data, length):
    out = []
    first = {}
    for d, t in data:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            first[s] = min(first.get(s, (True, 0)), key(d))
    for d, t in data:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < key(d):
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_suffix_dedup(docs, block):
    want = brute_suffix([(r[0], r[1]) for r in rows()], 50)
    assert sum(r[2] for r in want) > 1000
    assert collected(suffix.suffix_dedup(docs, block_bytes=block, min_buckets=3).drop("spans")) == want


def test_suffix_dedup_on_edges(spark, monkeypatch):
    monkeypatch.setattr(suffix, "_SLICE", 256)
    rng = random.Random(3)
    passage = "".join(rng.choice("abcd ") for _ in range(400))
    data = []
    for i in range(60):  # pieces of one passage, of any length around the threshold, in random surroundings
        a = rng.randrange(300)
        text = "".join(rng.choice("abcd ") for _ in range(rng.randrange(80))) + passage[a:a + rng.choice([30, 49, 50, 51, 60, 75, 100, 400])]
        data.append((rng.randrange(40), text + "".join(rng.choice("abcd ") for _ in range(rng.randrange(80))) + "z" * rng.choice([0, 0, 120])))
    t = cut(spark.createDataFrame(data, "doc_id long, text string").repartition(4), "test-suffix")
    assert collected(suffix.suffix_dedup(t, block_bytes=700, min_buckets=2).drop("spans")) == brute_suffix(data, 50)


def test_lm_shared_beginnings_change_nothing():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 100, rng.integers(0, 7)).astype(np.uint8)) for _ in range(500)] + [b"a" * 70_000, b"a" * 70_000, b""]
    words += sorted(words)
    classes = rng.integers(0, 3, len(words))
    code = lm.Code(np.bincount(np.frombuffer(b" ".join(words), np.uint8), minlength=256))
    for k in (None, classes):
        plain, shared = lm.Bits(words, code), lm.Bits(words, code, share=True, classes=k)
        assert shared.n < plain.n
        for i in range(len(lm.PREDICTORS)):
            # the slot of a byte's first bit is that of the byte which stands for it
            first = np.zeros((2, plain.n_bytes), np.int64)
            for row, b in zip(first, (plain, shared)):
                slots = b.slots(i, 20, classes if k is not None else 0)
                row[b.byte[::-1]] = slots[::-1]
            np.testing.assert_array_equal(first[0], first[1][shared.node])


def test_mixing(docs):
    got = mixing.mix(docs, chunk=4).collect()
    assert sorted((r.doc_id, r.taken) for r in got if r.doc_id is not None) == sorted((r.doc_id, r.taken) for r in mixing.mix(docs, chunk=4).collect() if r.doc_id is not None)
    sizes = Counter()
    for r in rows():
        sizes[r[3]] += len((r[1] or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:  # share, cut, share the excess again
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        target |= share | {s: 2 * sizes[s] for s in over}
        if not over:
            break
        full |= set(over)
        left -= sum(2 * sizes[s] for s in over)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in order)
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted((r[0] or -1, len((r[1] or "").encode().split())) for r in rows())
    mixed = mixing.mixed(docs, chunk=4)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


def test_quality(docs, spark):
    labels = spark.createDataFrame([(i * 3, i % 2, 0) for i in range(20)] + [(None, 1, 1), (3, 1, 0), (0, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.resample(docs, labels, share=0.5).collect()
    assert len(got) == len(rows()) and sum(r.kept for r in got) == len(rows()) // 2
    assert min(r.gumbel_key for r in got if r.kept) >= max(r.gumbel_key for r in got if not r.kept)
    keys = spark.createDataFrame([(i, float(i % 7)) for i in range(1000)], "_row long, key double")
    want = sorted(((i % 7, -i) for i in range(1000)), reverse=True)
    for k in (1, 10, 143, 500, 1000):
        assert quality.kth_largest(keys, k, buckets=4, few=5) == (want[k - 1][0], -want[k - 1][1])
    assert quality.kth_largest(keys, 1001) is None


def test_quality_weight_is_a_sum(spark):
    texts = ["fine", "fine words", "poor stuff", "fine words " * 500]
    t = cut(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "test-quality")
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    got = {r.doc_id: r.log_weight for r in quality.importance(t, labels).collect()}
    # fine, words, "fine words": 500 of each; "words fine" 499 times, as the target lacks it, about 0 and no more
    assert abs(got[3]) > 100 * abs(got[1]) > 0 and got[3] * got[1] > 0


def test_quality_tells_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.resample(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id")
    share = {r.quality: r.k for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert share[1] > 0.95 and share[0] < 0.2


def test_language_id(docs, spark):
    got = langid.identify(docs)
    assert {*docs.columns, "held_out", "lang_pred", "score"} <= set(got.columns)
    for r in got.collect():
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    sf = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert langid.identify(sf).filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_language_mixture():
    rng = random.Random(1)
    a, b = ["lorem", "ipsum", "dolor", "amet"], ["xkqz", "wvvy", "zzkk", "qyx"]
    counts = np.zeros((2, len(langid.LENGTHS), 1 << 12))
    for k, vocabulary in enumerate((a, b)):
        for data in langid._slices([" ".join(rng.choice(vocabulary) for _ in range(500))]):
            for i, s in enumerate(langid.gram_slots(data, 12)):
                counts[k, i] += np.bincount(s, minlength=1 << 12)
    model = langid.Model(["a", "b"], counts, 12)
    text = " ".join([rng.choice(a) for _ in range(70)] + [rng.choice(b) for _ in range(30)])
    langs, parts = langid.infer(model.word_scores(np.frombuffer(langid.words_of(text) + b" ", np.uint8)), 2.0, 30, 0.5)
    assert list(langs) == [0, 1] and parts == pytest.approx([0.7, 0.3], abs=0.05)
    langs, parts = langid.infer(model.word_scores(np.frombuffer(b"lorem ipsum amet ", np.uint8)), 2.0, 30, 0.5)
    assert list(langs) == [0] and parts[0] == 1.0


def brute_prints(texts, shingle=4):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [b" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        out.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    return out


def test_simhash(docs):
    data = rows()
    prints = brute_prints([r[1] for r in data])
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(data)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(data):
        least[find(i)] = min(least.get(find(i), (True, 0)), key(r[0]))
    want = sorted(((r[0], f"{prints[i]:016x}", None if least[find(i)][0] else least[find(i)][1]) for i, r in enumerate(data)), key=repr)
    got = simhash.simhash_components(docs, chunk=3)
    assert collected(got.select("doc_id", simhash.hex_fingerprint(F.col("fp")), "component_id")) == want
    assert simhash.simhash_dedup(docs).count() == len({r.root for r in got.select("root").distinct().collect()})


def test_simhash_dedup_keeps_distinct_texts_of_null_and_repeated_ids(spark, tmp):
    data = [(i, " ".join(f"{c}{k}" for k in range(40))) for i, c in [(None, "a"), (None, "b"), (None, "c"), (5, "d"), (5, "e"), (6, "f"), (7, "f"), (None, "f")]]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(tmp + "/d")
    kept = simhash.simhash_dedup(spark.read.parquet(tmp + "/d")).collect()
    assert sorted((r.text[0], r.doc_id or 0) for r in kept) == [("a", 0), ("b", 0), ("c", 0), ("d", 5), ("e", 5), ("f", 6)]


def test_draws_do_not_depend_on_the_split(spark, docs, tmp):
    labels = spark.createDataFrame([(i * 3, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    for n in (1, 7):
        docs.repartition(n, F.rand(n)).write.parquet(f"{tmp}/{n}")
    one, many = (spark.read.parquet(f"{tmp}/{n}") for n in (1, 7))
    mix = lambda d: collected(mixing.mix(d, chunk=4).select("doc_id", "source", "size", "taken"))
    assert mix(one) == mix(many)
    kept = lambda d: collected(quality.resample(d, labels, share=0.5).select("doc_id", F.round("log_weight", 6), "kept"))
    assert kept(one) == kept(many)


def test_language_id_keeps_clashing_columns(spark, docs):
    clash = docs.withColumn("_p", F.lit(1)).withColumn("score", F.lit("x")).withColumn("rest", F.lit(2)).withColumn("found", F.lit(3)).withColumn("a.b", F.lit(4))
    got = langid.identify(clash)
    assert {"_p", "rest", "found", "a.b"} <= set(got.columns) and got.select("`a.b`", "_p", "found").distinct().collect() == [(4, 1, 3)]


def test_quality_fits_on_bounded_labels(spark, docs):
    labels = spark.createDataFrame([(i * 3, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    few = quality.importance(docs, labels, max_labels=2).collect()
    assert len(few) == len(rows()) and {r.log_weight for r in few} != {r.log_weight for r in quality.importance(docs, labels).collect()}


def test_golay_cover():
    anchors = simhash.Anchors(1)
    assert len(set(anchors.words.tolist())) == 4096 and min(bin(w).count("1") for w in anchors.words[1:]) == 7
    x = np.random.default_rng(1).integers(0, 1 << 23, 300)
    near = np.bitwise_count(x ^ anchors.nearest(x))
    assert near.max() == 3
    at, words = anchors.within(x)
    for i in range(50):
        assert sorted(words[at == i]) == sorted(w for w in anchors.words.tolist() if bin(w ^ int(x[i])).count("1") <= 4)


def test_simhash_finds_all_links(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-2**63, 2**63 - 1, 40)
    far = [b ^ np.bitwise_or.reduce(np.int64(1) << rng.choice(62, rng.integers(0, 7), replace=False)) for b in np.repeat(base, 8)]
    fp = np.unique(np.array(far, np.int64))
    found = simhash.links(cut(spark.createDataFrame([(int(x),) for x in fp], "fp long"), "test-links"), 4, chunk=5)
    roots = {r.node: r.root for r in components.components(found).collect()}
    parent = {int(x): int(x) for x in fp}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, x in enumerate(fp):
        for y in fp[:i][np.bitwise_count(fp[:i] ^ x) <= 4]:
            parent[find(int(x))] = find(int(y))
    classes = lambda f: {frozenset(y for y in parent if f(y) == r) for r in map(f, parent)}
    assert classes(lambda x: roots.get(x, x)) == classes(find)


def test_forest_keeps_what_earlier_slices_joined():
    far, top = np.int64(0x0F0F0F0F0F0F0F), np.int64(1) << 61
    five, three, two = top, np.int64(0xF << 44), np.int64(0xF << 48)
    ten, eleven = three | top, two | top
    # two rows of x to a slice: five joins ten and eleven, then each of them gets its own smaller root
    x = np.array([five, five, three, two])
    y = np.concatenate([[ten, eleven], np.full((1 << 19) - 2, far)])
    a, b = simhash._forest(x, y, 4)
    assert set(a.tolist()) == {int(v) for v in (three, five, ten, eleven, two)} - set(b.tolist()) and len(set(b.tolist())) == 1
    # more than 2^20 pairs of dense families, in many slices
    rng = np.random.default_rng(4)
    base = rng.integers(-2**63, 2**63 - 1, 60)
    x, y = (base[rng.integers(0, 60, 1500)] ^ np.bitwise_or.reduce(np.int64(1) << rng.integers(0, 62, (1500, 4)), axis=1) for _ in range(2))
    a, b = simhash._forest(x, y, 4)
    parent = {v: v for v in np.concatenate([x, y]).tolist()}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for u in x.tolist():
        for v in y[np.bitwise_count(y ^ np.int64(u)) <= 4].tolist():
            parent[find(u)] = find(v)
    roots = dict(zip(a.tolist(), b.tolist()))
    classes = lambda f: {frozenset(v for v in parent if f(v) == r) for r in map(f, parent)}
    assert classes(lambda v: roots.get(v, v)) == classes(find)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 120)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 31)} | {i: 100 for i in range(101, 120)} | {201: 200}


def test_shards_are_read_from_any_slot(spark, docs, tmp):
    path, stride = tmp + "/shards", tokens.record_stride(16)
    every = {r.slot: tuple(r) for r in tokens.training_order(docs, path, length=16, per_shard=32).collect()}
    for slot in (0, 31, 32, 77, len(every) - 1, len(every)):
        rest = tokens.read_shards(spark, path, 16, 32, from_slot=slot)
        assert {r.slot: tuple(r) for r in rest.collect()} == {k: v for k, v in every.items() if k >= slot}
        assert all(int(f.split("shard=")[1].split("/")[0]) >= slot // 32 for r in rest.select("shard").distinct().collect() for f in [f"shard={r.shard}/"])
    # each shard is one file of fixed stride
    import pathlib
    files = sorted(pathlib.Path(path).glob("shard=*/part-*"))
    assert len(files) == -(-len(every) // 32) and sum(f.stat().st_size for f in files) == stride * len(every)


def test_slots_are_the_permutation_of_the_sequences(spark, docs, tmp):
    """Every sequence's slot from an independent walk of the permutation, numbered in the table's order."""
    got = tokens.training_order(docs, tmp + "/s", length=16, per_shard=32, key=9).collect()
    total, half = len(got), tokens.half_bits(len(got))
    keys = [int.from_bytes(hashlib.sha256(f"9:{r}".encode()).digest()[:8], "little") for r in range(4)]

    def walk(x):
        while True:
            left, right = x >> half, x & ((1 << half) - 1)
            for k in keys:
                f = (right + k) * 0x9E3779B97F4A7C15 % 2**64
                f = (f ^ f >> 29) * 0xBF58476D1CE4E5B9 % 2**64
                left, right = right, left ^ ((f ^ f >> 32) & ((1 << half) - 1))
            x = left << half | right
            if x < total:
                return x

    t = tokens.tokenizer(tokens.TOKENIZER)
    numbers = []
    for r in docs.withColumn("_at", F.monotonically_increasing_id()).orderBy("_at").collect():
        n = -(-(t.count(r.text or "") + 1) // 16)
        numbers += [(r.doc_id, k) for k in range(n)]
    assert sorted((walk(i), *x) for i, x in enumerate(numbers)) == sorted(((r.slot, r.doc_id, r.seq) for r in got), key=lambda x: x[0])


def test_feistel():
    for n in (1, 2, 3, 10, 257, 5000):
        assert sorted(tokens.feistel(np.arange(n), n, 9)) == list(range(n))
    assert (tokens.feistel(np.arange(1000), 1000, 1) != tokens.feistel(np.arange(1000), 1000, 2)).mean() > 0.9


def test_training_order_round_trip(docs, tmp):
    got = tokens.training_order(docs, tmp + "/shards", length=16, per_shard=32).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert all(r.shard == r.slot // 32 and r.byte_offset == (r.slot % 32) * tokens.record_stride(16) for r in got)
    t = tokens.tokenizer(tokens.TOKENIZER)
    whole = defaultdict(list)
    for r in sorted(got, key=lambda r: r.seq):
        whole[r.doc_id].append((r.seq, np.frombuffer(r.ids, "<u2").tolist()))
    by_id = defaultdict(list)
    for r in rows():
        by_id[r[0]].append(r[1] or "")
    assert set(whole) == set(by_id)
    for d, texts in by_id.items():
        if len(texts) == 1:
            ids = [x for _, part in whole[d] for x in part]
            assert ids[-1] == tokens.END_OF_TEXT and tokens.END_OF_TEXT not in ids[:-1]
            assert t.decode(ids[:-1]) == texts[0] and ids[:-1] == t.encoding.encode_ordinary(texts[0])


def test_pieces_are_encoded_as_in_the_whole():
    t = tokens.tokenizer(tokens.TOKENIZER)
    for text in ("a  b\n\n c \t d", " lead", "trail  ", "x'll 12,5%  \n", "\n\n", "ü ß z　 y", ""):
        assert np.frombuffer(t.encode(text), "<u2").tolist() == t.encoding.encode_ordinary(text)


def test_empty_tables(spark, empty, tmp):
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (exact.exact_dedup(empty), lines.line_dedup(empty), lm.score(empty), decontam.decontaminate(empty, bench), suffix.suffix_dedup(empty),
               mixing.mix(empty), quality.resample(empty, labels), langid.identify(empty), simhash.simhash_components(empty), tokens.training_order(empty, tmp + "/none")):
        assert df.count() == 0


def test_pipeline(spark, docs, tmp):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        new = cut(stage(spark, frame, sf), "test-pipeline")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert new.columns == frame.columns
        frame = new
    assert frame.filter("doc_id is not null").count() > 0


def test_pipeline_on_a_table(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    sequences = out.count()
    assert sequences == out.agg(F.max("slot")).first()[0] + 1
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    bad = {r.doc_id for r in decontam.decontaminate(docs, bench).filter("contaminated").collect()}
    assert not bad & {r.doc_id for r in out.select("doc_id").distinct().collect()}


def test_tokenizer_cuts_long_texts_safely():
    """Cuts before white space leave the ids as they are; where there is no such place, the round trip still holds."""
    whole, small = tokens.Tokenizer(tokens.TOKENIZER), tokens.Tokenizer(tokens.TOKENIZER, piece=20, most=400)
    rng = np.random.default_rng(3)
    for _ in range(200):
        text = "".join(rng.choice(list(" \n\t ab1.é"), 1500))
        assert small.encode(text) == whole.encode(text) and small.count(text) * 2 == len(small.encode(text))
    for text in (" " * 700_000, " " * 700_000 + "a", "a" * 600_000):
        assert whole.decode(np.frombuffer(whole.encode(text), "<u2")) == text
