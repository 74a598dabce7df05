"""Language ID by multilingual mixture inference (after Lui, Lau and Baldwin 2014).

Learning counts hashed letter n-grams per language over the labelled training documents. A document is a mixture of
languages: each word was written in one of them, and expectation-maximisation estimates the proportions from the words'
n-gram likelihoods. The language set is selected by penalised likelihood: the languages are ranked by their
proportion in the full mixture, and the sets of the first 1, 2, ... are compared by their likelihood less a
penalty per language. The prediction is the language with the largest proportion in the selected set.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_rows

UNDETERMINED = "und"
#: n-gram lengths in bytes; each has a table of its own.
LENGTHS = (1, 2, 3, 4)
_BLANK = 0x20
_LETTERLESS = bytes.maketrans(bytes(range(0x00, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)), b" " * (0x41 + 6 + 5))


def held_out(doc_id: Column, divisor: int, remainders) -> Column:
    """Whether crc32 of the doc_id as text leaves one of ``remainders``; a null doc_id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor)).isin(*remainders), F.lit(False))


def words_of(text: str) -> bytes:
    """Lower-case UTF-8 letters; runs of other ASCII characters become one blank."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERLESS).split())


def gram_slots(data: np.ndarray, bits: int) -> list[np.ndarray]:
    """For each length, the slot of the n-gram that ends at each byte; it may begin in the word before."""
    x = np.concatenate([np.full(max(LENGTHS) - 1, _BLANK, np.uint8), data])
    out, n = [], len(data)
    for k in LENGTHS:
        h = np.full(n, k, np.uint32)
        for i in range(k):
            lo = max(LENGTHS) - k + i
            h *= np.uint32(0x01000193)
            h ^= x[lo:lo + n]
        h *= np.uint32(0x9E3779B1)
        out.append((h >> np.uint32(32 - bits)).astype(np.int32))
    return out


class Model:
    """log P(byte | the bytes before it, language) as interpolated, smoothed n-gram frequencies."""

    def __init__(self, languages: list[str], counts: np.ndarray, bits: int):
        # counts: language x length x slot
        self.languages, self.bits = languages, bits
        totals = np.maximum(counts.sum(axis=2, keepdims=True), 1.0)
        alpha = 0.5
        logs = np.log((counts + alpha) / (totals + alpha * counts.shape[2])) / len(LENGTHS)
        self.logs = np.ascontiguousarray(logs.transpose(1, 2, 0).astype(np.float32))  # length x slot x language

    def word_scores(self, data: np.ndarray) -> np.ndarray:
        """Log likelihood of each word (blanks end them) in each language; long texts go by slices that end with a word."""
        size = max(1 << 12, (1 << 23) // len(self.languages))
        out, lo = [np.zeros((0, len(self.languages)))], 0
        while lo < len(data):
            hi = len(data)
            if hi - lo > size:
                ends = np.flatnonzero(data[lo + size:] == _BLANK)
                hi = lo + size + int(ends[0]) + 1 if len(ends) else hi
            part = data[lo:hi]
            score = sum(self.logs[i][s] for i, s in enumerate(gram_slots(part, self.bits)))
            starts = np.flatnonzero(np.concatenate([[True], part[:-1] == _BLANK]))
            out.append(np.add.reduceat(score, starts, axis=0))
            lo = hi
        return np.concatenate(out)


def _em(likelihood: np.ndarray, weights: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions of the columns and the log likelihood; likelihood: distinct words x languages, the largest 1 in each row."""
    n, k = weights.sum(), likelihood.shape[1]
    theta = np.full(k, 1.0 / k)
    for _ in range(rounds):
        mix = likelihood * theta
        mix /= np.maximum(mix.sum(axis=1, keepdims=True), 1e-300)
        new = weights @ mix / n
        if np.abs(new - theta).max() < 1e-4:
            theta = new
            break
        theta = new
    return theta, float(weights @ np.log(np.maximum(likelihood @ theta, 1e-300)))


def infer(scores: np.ndarray, penalty: float, rounds: int, temper: float) -> tuple[np.ndarray, np.ndarray]:
    """(languages, proportions), the largest proportion first, of a document with these word scores."""
    tempered = scores * temper
    likelihood = np.exp(tempered - tempered.max(axis=1, keepdims=True))
    weights = np.ones(len(scores))
    theta, _ = _em(likelihood, weights, rounds)
    order = np.argsort(-theta, kind="stable")
    cost = penalty * np.log(len(scores) + 1.0)
    best = None
    for size in range(1, len(order) + 1):
        chosen = order[:size]
        part, fit = (np.ones(1), float(np.log(np.maximum(likelihood[:, chosen[0]], 1e-300)).sum())) if size == 1 else _em(likelihood[:, chosen], weights, rounds)
        value = fit - cost * size
        if best is not None and value <= best[0]:
            break  # the next language doesn't pay for itself
        best = (value, chosen, part)
    _, chosen, part = best
    rank = np.argsort(-part, kind="stable")
    return chosen[rank], part[rank]


def train(labelled: DataFrame, bits: int = 16) -> Model | None:
    """Counts n-grams of (text, lang) rows per language; the model has 4 bytes x 4 x 2^bits per language.

    Each task sums its rows in arrays, and the arrays are summed per language and length.
    """
    def count(batches):
        tables: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, texts in pdf.groupby("lang", sort=False)["text"]:
                table = tables.setdefault(lang, np.zeros((len(LENGTHS), 1 << bits), np.int64))
                for data in _slices(texts):
                    for i, slots in enumerate(gram_slots(data, bits)):
                        table[i] += np.bincount(slots, minlength=1 << bits)
        for lang, table in tables.items():
            for i in range(len(LENGTHS)):
                yield pd.DataFrame({"lang": [lang], "length": [i], "counts": [table[i].tobytes()]})

    def merge(batches):
        sums: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            for lang, i, blob in zip(pdf["lang"], pdf["length"], pdf["counts"]):
                x = np.frombuffer(blob, np.int64)
                sums[lang, i] = sums[lang, i] + x if (lang, i) in sums else x
        for (lang, i), x in sums.items():
            yield pd.DataFrame({"lang": [lang], "length": [i], "counts": [x.astype(np.float32).tobytes()]})

    kind = "lang string, length int, counts binary"
    parts = labelled.select("text", "lang").mapInPandas(count, kind)
    summed = parts.repartition("lang", "length").mapInPandas(merge, kind).collect()  # the model itself
    if not summed:
        return None
    languages = sorted({r["lang"] for r in summed})
    counts = np.zeros((len(languages), len(LENGTHS), 1 << bits))
    for r in summed:
        counts[languages.index(r["lang"]), r["length"]] = np.frombuffer(r["counts"], np.float32)
    return Model(languages, counts, bits)


def _slices(texts, size: int = 1 << 22):
    """The texts' words as byte arrays of about ``size`` bytes; a text is never broken."""
    held, n = [], 0
    for t in texts:
        w = words_of(t)
        held.append(w + b" ")
        n += len(w)
        if n >= size:
            yield np.frombuffer(b"".join(held), np.uint8)
            held, n = [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.uint8)


def identify(docs: DataFrame, divisor: int = 4, remainders=(2,), bits: int = 16, penalty: float = 2.0, rounds: int = 30,
             temper: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with held_out, lang_pred, score, langs and proportions (the selected set) in front of no other change.

    Learns from the rows that are not held out and have a text and a lang. A text that is null or has no letter is
    'und' with score 0; so is every text if nothing could be learned. ``score`` is the proportion of the predicted
    language. Ties go to the language first by code point. Repeated rows count and are predicted like others. An
    empty table gives an empty result. Columns of ``docs`` with the result's names are replaced.
    """
    apart = held_out(F.col(id_col), divisor, remainders)
    labelled = docs.filter(~apart & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    model = train(labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), bits)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)

    def one(text: str | None, m: Model | None):
        if m is None or text is None or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, [], []
        scores = m.word_scores(np.frombuffer(words_of(text) + b" ", np.uint8))
        langs, parts = infer(scores, penalty, rounds, temper)
        return m.languages[langs[0]], float(min(1.0, max(0.0, parts[0]))), [m.languages[i] for i in langs], [float(p) for p in parts]

    @F.pandas_udf("lang_pred string, score double, langs array<string>, proportions array<double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t, sent.value) for t in texts], columns=["lang_pred", "score", "langs", "proportions"])

    new = ("held_out", "lang_pred", "score", "langs", "proportions")
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in new] or [F.lit(None).alias("_none")])
    out = docs.select(rest.alias("rest"), apart.alias("held_out"), predict(F.col(text_col)).alias("found"))
    return out.select(*[F.col(f"rest.`{c}`") for c in docs.columns if c not in new], "held_out", *[F.col(f"found.{c}") for c in new[1:]])


def known_language(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a language that holds at least ``min_score`` of their words; 'und' goes, and so do null, empty and letterless texts.

    Repeated rows are judged alike; a null doc_id or lang changes nothing but what is learned. All columns are kept, whatever their names; an empty table stays empty.
    """
    found = identify(whole_rows(docs).select("_doc", "_doc.doc_id", "_doc.text", "_doc.lang"))
    return found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)).select("_doc.*")
