"""Benchmark decontamination by template canonicalisation. DataFrame functions only.

Texts become templates: numbers and the units after them turn into typed placeholders, the rest is lower-cased and loses its
punctuation. Names can't be told from other words in a document (sentences begin with capitals, copies may be in one case), so
the item alone says where they may stand: any of its capitalised words is a slot that takes any word of the document.

Short windows of template tokens, the seeds, are hashed, and the documents' windows are joined with the benchmark's. Each seed
gives an alignment of document and item, along which all tokens are compared. A question whose numbers, units or names were
changed has the same template, so the slots are checked then: within one alignment, each value of the item must stand for one
value of the document throughout, otherwise the alignment is a chance meeting and is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, whole_rows, with_row_id

#: Placeholder openings of numbers and units, their end, and what is put before a capitalised word: characters for private use.
NUMBER, NAME, UNIT, END = "\ue001", "\ue002", "\ue003", "\ue004"
_SPLIT = "\ue005"
UNITS = ("km/h|mph|kmh|kilometers?|kilometres?|km|centimeters?|centimetres?|cm|millimeters?|mm|meters?|metres?|miles?|mi|feet|foot|ft|inch(?:es)?|"
         "kilograms?|kg|milligrams?|mg|grams?|g|pounds?|lbs?|ounces?|oz|tons?|liters?|litres?|ml|gallons?|l|"
         "seconds?|secs?|s|minutes?|mins?|min|hours?|hrs?|h|days?|weeks?|months?|years?|yrs?|"
         "dollars?|usd|euros?|eur|cents?|pence|percent|degrees?|celsius|kelvin|volts?|v|watts?|w|amps?|hz|%|\\$|€|£|°[CF]?")
_NUMBER_RE = rf"(?i)([$€£]?\d+(?:[.,:/]\d+)*)(?:[\s ]*({UNITS})(?![\p{{L}}\d]))?"
_NAME_RE = r"(?<![\p{L}\p{N}'’])(\p{Lu})"
#: Kinds of seeds: numbers and units as placeholders; capitalised words too; every token as it is.
PLAIN, NAMED, LITERAL = 0, 1, 2


def template(text: Column, names: bool) -> Column:
    """Tokens of the text: words, and numbers and units as opening, value and END. ``names``: NAME stands before capitalised words."""
    text = F.coalesce(text, F.lit(""))
    if names:
        text = F.regexp_replace(text, _NAME_RE, NAME + "$1")
    text = F.regexp_replace(text, _NUMBER_RE, NUMBER + "$1" + END + UNIT + "$2" + END)
    marks = f"{NUMBER}{UNIT}"
    # an apostrophe between letters stays, as one character
    text = F.regexp_replace(F.translate(F.lower(text), "’", "'"),
                            rf"([{marks}][^{END}]*{END})|(?:[^\p{{L}}\p{{N}}{marks}{NAME}']|(?<!\p{{L}})'|'(?!\p{{L}}))+", _SPLIT + "$1" + _SPLIT)
    return F.filter(F.split(text, f"{_SPLIT}+"), lambda t: t != "")


def _opening(token: Column) -> Column:
    return F.substring(token, 1, 1)


def _word(token: Column) -> Column:
    return F.ltrim(token, F.lit(NAME))


def seed_tokens(tokens: Column, kind: int) -> Column:
    """What is hashed of tokens of ``template``."""
    if kind == LITERAL:
        return F.transform(tokens, _word)
    slots = (NUMBER, UNIT, NAME) if kind == NAMED else (NUMBER, UNIT)
    return F.transform(tokens, lambda t: F.when(_opening(t).isin(*slots), _opening(t)).otherwise(_word(t)))


def windows(tokens: Column, width: int) -> Column:
    """Hash of the window that begins at each token; empty if there are fewer tokens than ``width``."""
    n = F.size(tokens) - width
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(F.slice(tokens, i + 1, F.lit(width))))).otherwise(F.array().cast("array<bigint>"))


def benchmark_seeds(tokens: DataFrame, seed: int, min_words: int) -> DataFrame:
    """(kind, width, h, item, ix) of items (item, it) with at least ``min_words`` tokens.

    PLAIN seeds hold ``seed`` tokens, at most two of them placeholders. An item without such seeds that are free of names has
    NAMED ones as well, and one without any PLAIN seed (short, or mostly numbers) LITERAL ones, of its own length if it is shorter.
    """
    tokens = tokens.filter(F.size("it") >= min_words)
    parts = []
    for kind, width in ((PLAIN, seed), (NAMED, seed), *((LITERAL, w) for w in range(min_words, seed + 1))):
        some = tokens if kind != LITERAL or width == seed else tokens.filter(F.size("it") == width)
        some = some.select("item", "it", seed_tokens(F.col("it"), kind).alias("s"))
        parts.append(some.select("item", "it", F.lit(kind).alias("kind"), F.lit(width).alias("width"), F.posexplode(windows(F.col("s"), width)).alias("ix", "h")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    held = F.slice("it", F.col("ix") + 1, F.col("width"))
    every = every.withColumn("words", F.size(F.filter(held, lambda x: ~_opening(x).isin(NUMBER, UNIT)))).withColumn(
        "names", F.size(F.filter(held, lambda x: _opening(x) == NAME))).drop("it")
    good = (F.col("kind") == LITERAL) | (F.col("words") >= F.col("width") - 2)
    every = every.filter(good)
    has = every.groupBy("item").agg(F.max(F.col("kind") == PLAIN).alias("plain"), F.max((F.col("kind") == PLAIN) & (F.col("names") == 0)).alias("free"))
    needed = (F.col("kind") == PLAIN) | ((F.col("kind") == NAMED) & F.col("plain") & ~F.col("free")) | ((F.col("kind") == LITERAL) & ~F.col("plain"))
    return every.join(has, "item").filter(needed).select("kind", "width", "h", "item", "ix")


def item_windows(it: Column, width: int, min_words: int) -> Column:
    """Number of the item's windows with at least ``min_words`` tokens that aren't slots; of all of its windows if there are none such."""
    w = F.least(F.lit(width), F.size(it))
    every = F.sequence(F.lit(0), F.size(it) - w)
    plain = F.filter(every, lambda i: F.size(F.filter(F.slice(it, i + 1, w), lambda x: ~_opening(x).isin(NUMBER, NAME, UNIT))) >= min_words)
    return F.when(F.size(plain) > 0, F.size(plain)).otherwise(F.size(every))


def compared(placed: DataFrame, width: int, min_words: int) -> DataFrame:
    """(_row, item, n, good) of alignments (_row, item, shift, it, n, t) with consistent slots; good: places of the windows that agree."""
    pairs = F.transform("it", lambda x, i: F.struct(x.alias("a"), F.get("t", F.col("shift") + i).alias("b")))
    kind = lambda x: _opening(x["a"])
    agree = lambda x: F.coalesce(
        F.when(kind(x).isin(NUMBER, UNIT), _opening(x["b"]) == kind(x)).when(kind(x) == NAME, ~_opening(x["b"]).isin(NUMBER, UNIT)).otherwise(x["a"] == x["b"]), F.lit(False))
    same = lambda x: (_word(x["a"]) == x["b"]) & (x["a"] != UNIT + END)
    w = F.least(F.lit(width), F.size("p"))
    good = F.filter(F.sequence(F.lit(0), F.size("p") - w), lambda i: F.forall(F.slice("p", i + 1, w), agree) & (
        F.size(F.filter(F.slice("p", i + 1, w), lambda x: F.coalesce(same(x), F.lit(False)))) >= min_words))
    held = F.array_distinct(F.flatten(F.transform("good", lambda g: F.sequence(g, g + w - 1))))
    # a number without a unit may meet any word that looks like one
    slots = F.array_distinct(F.filter(F.transform(held, lambda i: F.get("p", i)), lambda x: kind(x).isin(NUMBER, NAME, UNIT) & (x["a"] != UNIT + END)))
    placed = placed.select("_row", "item", "n", pairs.alias("p")).withColumn("good", good).filter(F.size("good") > 0).withColumn("slots", slots)
    return placed.filter(F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda x: x["a"])))).select("_row", "item", "n", "good")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 8, min_words: int = 4, min_hits: int = 6,
                  broadcast_windows: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", seed: int = 5, share: float = 2 / 3) -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, contaminated, item_ids (sorted), n_windows (summed over these items).

    A window agrees if all its tokens do and at least ``min_words`` of them are the same words or values. A document is
    contaminated by an item if windows at ``min_hits`` places of the item, or at a ``share`` of its places if that is fewer,
    agree with it with consistent slots. An item shorter than ``width`` is one window. Null or empty texts, and items of fewer
    than ``min_words`` tokens, match nothing. Repeated rows are judged alike, repeated items count once each; an item without id
    is ignored. Other columns are not read. Empty tables give an empty or a clean result.

    The benchmark's seeds, of ``seed`` tokens, are broadcast if there are at most ``broadcast_windows``, else joined by shuffle.
    """
    rows = with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).filter("item is not null and text is not null").distinct()
    item_tokens = cut(items.select("item", template(F.col("text"), True).alias("it")).distinct().withColumn("text_id", F.xxhash64("it")), "decontam-items")
    known = cut(benchmark_seeds(item_tokens.select(F.struct("item", "text_id").alias("item"), "it"), seed, min_words), "decontam-windows")
    few = known.count() <= broadcast_windows
    passes = [(r["kind"], r["width"]) for r in known.select("kind", "width").distinct().orderBy("kind", "width").collect()]
    hits = None
    for kind, wide in passes or [(PLAIN, seed)]:
        tokens = rows.select("_row", seed_tokens(template(F.col("text"), kind == NAMED), kind).alias("t"))
        spread = tokens.select("_row", F.posexplode(windows(F.col("t"), wide)).alias("at", "h"))
        some = known.filter((F.col("kind") == kind) & (F.col("width") == wide)).select("h", "item", "ix")
        met = spread.join(F.broadcast(some) if few else some, "h").select("_row", "item.*", (F.col("at") - F.col("ix")).alias("shift"))
        hits = met if hits is None else hits.unionByName(met)
    hits = cut(hits.distinct(), "decontam-hits")

    # the few texts that matched are read again, with their values
    candidates = hits.select("_row").distinct()
    texts = rows.join(candidates, "_row", "left_semi").select("_row", template(F.col("text"), False).alias("t"))
    sized = item_tokens.filter(F.size("it") >= min_words).withColumn("n", item_windows(F.col("it"), width, min_words))
    placed = hits.join(sized, ["item", "text_id"]).join(texts, "_row")
    good = compared(placed, width, min_words).select("_row", "item", "n", F.explode("good").alias("ix"))
    found = good.groupBy("_row", "item").agg(F.countDistinct("ix").alias("hits"), F.min("n").alias("n"))
    found = found.filter(F.col("hits") >= F.least(F.lit(min_hits), F.ceil(F.col("n") * share - 1e-9)))
    per_row = found.groupBy("_row").agg(F.sort_array(F.collect_set("item")).alias("item_ids"), F.sum("hits").alias("n_windows"))
    out = rows.select("_row", "doc_id").join(per_row, "_row", "left")
    none = F.array().cast(per_row.schema["item_ids"].dataType)
    return out.select("_row", "doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("item_ids", none).alias("item_ids"),
                      F.coalesce("n_windows", F.lit(0)).alias("n_windows"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates. Null and empty texts and repeated rows are judged as in :func:`decontaminate`; all columns are kept, whatever their names; an empty table stays empty."""
    bad = decontaminate(docs, benchmark).filter("contaminated").select("_row")
    return whole_rows(docs).join(bad, "_row", "left_anti").select("_doc.*")
