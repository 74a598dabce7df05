"""Recall of decontamination on questions whose names, numbers and units were changed."""

import random
from collections import Counter

from factline.llm import decontam
from factline.llm.common import cut

FIRST = "Amara Boris Chen Dilan Esme Farid Greta Hugo Ines Jonas Kaya Liam Mona Nadia Oskar Priya".split()
LAST = "Smith Jones Okafor Tanaka Rossi Weber Novak Silva".split()
NOUNS = ("basket river garden market bridge village teacher farmer window paper bottle castle forest ladder mirror pocket rocket saddle "
         "tunnel wagon anchor barrel candle dragon engine").split()
UNITS = "km kg hours dollars minutes meters".split()
#: Braces: a name (n), a number (x), a unit (u); brackets: a noun.
CLAUSES = ["{n} bought {x} []s and a [] for {x} {u}", "{n} walked {x} {u} past the old [] to the []", "the [] near the [] holds {x} []s of {n}",
           "{n} gave {m} {x} more []s than the [] had before", "every [] in the [] needs {x} {u} until the [] is full"]


def question(rng):
    """Sentences with numbered slots."""
    out = []
    for i, clause in enumerate(rng.choices(CLAUSES, k=rng.randint(2, 5)) + ["how many []s does {n} have at the [] now?"]):
        while "[]" in clause:
            clause = clause.replace("[]", rng.choice(NOUNS), 1)
        while "{x}" in clause:
            clause = clause.replace("{x}", "{x%d}" % rng.randint(0, 7), 1)
        clause = clause.replace("{n}", f"{{n{i % 3}}}").replace("{m}", f"{{n{(i + 1) % 3}}}").replace("{u}", f"{{u{i % 3}}}")
        out.append(clause[0].upper() + clause[1:])
    return ". ".join(out)


def filled(rng, text, words):
    names = rng.sample(FIRST, 3)
    if words == 2:
        names = [f"{a} {b}" for a, b in zip(names, rng.sample(LAST, 3))]
    slots = {f"n{i}": v for i, v in enumerate(names)} | {f"u{i}": v for i, v in enumerate(rng.sample(UNITS, 3))}
    return text.format(**slots, **{f"x{i}": v for i, v in enumerate(rng.sample(range(2, 900), 8))})


def test_recall_on_changed_questions(spark):
    rng = random.Random(5)
    plain = lambda n: " ".join(rng.choice(NOUNS) + rng.choice(["", ",", "."]) for _ in range(n))
    items, texts, kinds = [], [], []
    for item in range(24):
        text, words = question(rng), 1 + item % 3 // 2
        items.append((item, filled(rng, text, words)))
        for kind, changed in (("same", filled(rng, text, words)), ("lower", filled(rng, text, words).lower()), ("length", filled(rng, text, 3 - words))):
            texts.append((len(texts), f"{plain(60)}\n{changed}\n{plain(20)}"))
            kinds.append((kind, item))
    texts += [(len(texts) + i, plain(120)) for i in range(20)]
    docs = cut(spark.createDataFrame(texts, "doc_id long, text string"), "test-recall")
    got = {r.doc_id: list(r.item_ids) for r in decontam.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    found = Counter(kind for i, (kind, item) in enumerate(kinds) if item in got[i])
    assert all(found[kind] >= 0.9 * 24 for kind in ("same", "lower", "length")), found
    assert not any(got[i] for i in range(len(kinds), len(texts)))
