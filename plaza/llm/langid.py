"""Language ID by interpolated Kneser-Ney character models.

One model of order four per language over lower-case letters and word ends. The
counts come from all labelled training rows. The probabilities of all languages for an
n-gram lie side by side in one array, found through the sorted n-grams (64 bits hold four symbols).
The language of the lowest cross-entropy per character wins; a temperature fitted on
labelled rows turns the entropies into a score, and a text whose score or entropy lies
outside what labelled rows show is rejected.

Bounds: the model has at most MODEL_GRAMS n-grams per order, shared evenly by the languages; only it
is sent to the driver and to the tasks. Counts and Kneser-Ney counts are made of all rows; where a language has more
n-grams of an order, the rarest go, by a least count, and their share of a context goes to its back-off. The temperature and the limits are fitted
on all labelled training rows.

Contract
- Rows whose ``crc32(doc_id)`` leaves 1 modulo 3 (``held_out``), or whose ``lang`` or ``text``
  is null, teach nothing. A null id counts as the empty text in that rule.
- ``lang_pred`` is ``und`` with score 0 if the text is null or has no letter, or nothing was
  learned. Ties go to the first language by name. Very long texts are read whole, in bounded
  slices that hand their last symbols on; the sums are those of the uncut text. Rows are judged one by one; an empty table gives none. Only ``doc_id``, ``text`` and
  ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plaza.llm.common import Scratch, batches_of, small_batches, whole_text
from plaza.operators.keys import top_per_key

ORDER = 4
MODEL_GRAMS = 1 << 21
SLICE_CHARS = 500_000
TEMPERATURES = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0]
# The share of a language's labelled rows that lies beyond its limits, and the room beyond that quantile.
REJECTED_SHARE, ROOM = 0.001, 1.25
UNKNOWN = "und"
# Surrogates and the private use area: code points that are no letters.
HIGH, HIGH_END = 0xD800, 0xF900

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool))
    return _letters[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and word ends (0x20) of all texts, 16 bits each, and where each text begins.
    Every text begins with a word end; runs of other characters are one word end. Letters above
    U+FFFF share the numbers that no letter below has (surrogates and private use)."""
    joined = "".join("\x00" + t.lower().replace("\x00", " ") for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    first = points == 0
    letter = letter_table()[points]
    keep = letter | first
    keep[1:] |= letter[:-1]
    points = np.where(points > 0xFFFF, HIGH + points % (HIGH_END - HIGH), points)
    codes = np.where(letter, points, 0x20)[keep].astype(np.uint64)
    return codes, np.flatnonzero(first[keep])


def grams_of(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-gram that ends at each symbol but the first of a text, and the text it is in."""
    n = len(codes)
    owner = np.zeros(n, dtype=np.int64)
    owner[starts[1:]] = 1
    owner = np.cumsum(owner)
    since = np.arange(n) - starts[owner]
    gram = codes.copy()
    for k in range(1, ORDER):
        gram[k:] |= np.where(since[k:] >= k, codes[:-k], np.uint64(0)) << np.uint64(16 * k)
    inner = since > 0
    return gram[inner], owner[inner]


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the n-grams of each language in a partition, merged slice by slice."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for frame in batches_of(frames, "text", SLICE_CHARS):
        for lang, rows in frame.groupby("lang"):
            grams, count = np.unique(grams_of(*symbols(rows.text.tolist()))[0], return_counts=True)
            if lang in held:
                known, n = held[lang]
                merged, place = np.unique(np.concatenate([known, grams]), return_inverse=True)
                count = np.bincount(place, np.concatenate([n, count])).astype(np.int64)
                grams = merged
            held[lang] = grams, count
            if len(grams) > MODEL_GRAMS:
                yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": count})
                del held[lang]
    for lang, (grams, count) in held.items():
        yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": count})


@dataclass
class Model:
    """Log probabilities of the n-grams that were seen, back-off weights of their contexts."""

    langs: list[str]
    grams: list[np.ndarray]        # per order, sorted
    logs: list[np.ndarray]         # per order, rows as n-grams, a column per language
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]
    floor: np.ndarray
    temperature: float = 1.0
    least_score: np.ndarray | None = None
    most_entropy: np.ndarray | None = None


def _lower(gram: np.ndarray, order: int) -> np.ndarray:
    return gram & np.uint64((1 << (16 * order)) - 1)


def _least_counts(sizes: pd.DataFrame, langs: int, bound: int) -> list[int]:
    """The count an n-gram of each language must have so that at most ``bound`` are left."""
    out = []
    for lang in range(langs):
        own = sizes[sizes["lang"] == lang].sort_values("bucket", ascending=False)
        fits = own.bucket[(own["rows"].cumsum() <= bound).to_numpy()]
        out.append(int(fits.iloc[-1]) if len(fits) else int(own.bucket.iloc[0]) * 2 if len(own) else 1)
    return out


def _kneser_ney(levels: Iterator[tuple[pa.Table, pd.DataFrame]], langs: list[str]) -> Model:
    """Probabilities, order by order from the first, from the kept counts, the counts of their contexts, and how many n-grams
    have each count. Only numbers, and one order at a time."""
    n_langs = len(langs)
    model = Model(langs, [], [], [], [], np.zeros(n_langs, np.float32))
    for order, (level, seen) in enumerate(levels, 1):
        lang, gram, count, context_count = (level[c].to_numpy() for c in ("lang", "gram", "n", "total"))
        lang, gram = lang.astype(np.int64), gram.view(np.uint64)
        count, context_count = count.astype(np.float64), context_count.astype(np.float64)
        del level
        if order == 1:
            letters = max(2, len(np.unique(gram)))
            model.floor = np.full(n_langs, np.log(1.0 / letters), np.float32)
            probability = np.full((1, n_langs), 1.0 / letters)
        discount = np.full(n_langs, 0.75)
        for i in range(n_langs):
            once, twice = (int(seen["rows"][(seen["lang"] == i) & (seen.bucket == k)].sum()) for k in (1, 2))
            if once and twice:
                discount[i] = once / (once + 2 * twice)
        contexts, at = np.unique(gram >> np.uint64(16), return_inverse=True)
        total, held, kinds = (np.zeros((len(contexts), n_langs)) for _ in range(3))
        total[at, lang] = context_count
        np.add.at(held, (at, lang), count)
        np.add.at(kinds, (at, lang), 1)
        weight = np.where(total > 0, (total - held + discount * kinds) / np.maximum(total, 1), 1.0)
        grams = np.unique(gram)
        own = np.zeros((len(grams), n_langs))
        own[np.searchsorted(grams, gram), lang] = np.maximum(count - discount[lang], 0) / context_count
        if order == 1:
            below = np.repeat(probability, len(grams), axis=0)
        else:
            # A lower n-gram is there for every language that has the longer one, unless it was too rare; others back off.
            lower = _lower(grams, order - 1)
            row = _rows(model.grams[-1], lower)
            below = probability[row]
            gone = np.flatnonzero(row < 0)
            if len(gone):
                below[gone] = np.exp(log_probabilities(model, lower[gone], order - 1))
        probability = own + weight[np.searchsorted(contexts, grams >> np.uint64(16))] * below
        model.grams.append(grams)
        model.logs.append(np.log(probability).astype(np.float32))
        model.contexts.append(contexts)
        model.backoffs.append(np.log(weight).astype(np.float32))
    return model


def _rows(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of n-grams among the sorted ones, -1 where one is not there."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def log_probabilities(model: Model, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Log probability of the last symbol of each n-gram, a column per language."""
    if order == 0:
        return np.repeat(model.floor[None, :], len(gram), axis=0)
    gram = _lower(gram, order)
    row = _rows(model.grams[order - 1], gram)
    out = model.logs[order - 1][row] if len(model.logs[order - 1]) else np.zeros((len(gram), len(model.langs)), np.float32)
    new = np.flatnonzero(row < 0)
    if len(new):
        missing = gram[new]
        context = _rows(model.contexts[order - 1], missing >> np.uint64(16))
        weight = np.zeros((len(new), len(model.langs)), np.float32)
        weight[context >= 0] = model.backoffs[order - 1][context[context >= 0]]
        out[new] = weight + log_probabilities(model, missing, order - 1)
    return out


def entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of negative log probabilities per text and language, and the symbols of each text."""
    codes, starts = symbols(texts)
    gram, owner = grams_of(codes, starts)
    total = np.zeros((len(texts), len(model.langs)))
    size = np.bincount(owner, minlength=len(texts))
    if len(gram):
        present = np.flatnonzero(size)
        begins = np.concatenate([[0], np.cumsum(size[present])[:-1]])
        total[present] = -np.add.reduceat(log_probabilities(model, gram), begins, axis=0, dtype=np.float64)
    return total, size


def _slices(text: str) -> Iterator[str]:
    """Parts of a very long text, cut behind a character that is no letter where there is one."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SLICE_CHARS)
        if end < len(text):
            cut = end
            while cut > at and text[cut - 1].isalpha():
                cut -= 1
            end = cut if cut > at else end
        yield text[at:end]
        at = end


def _long_entropies(model: Model, text: str) -> tuple[np.ndarray, np.ndarray]:
    """``entropies`` of one very long text, slice by slice. The last symbols go along as context, and no word end is
    put in where the text has none, so the sums are those of the whole."""
    total, size, tail, last = np.zeros((1, len(model.langs))), 0, np.zeros(0, np.uint64), ""
    for part in _slices(text):
        codes, _ = symbols([part])
        if last and (part[0].isalpha() or not last.isalpha()):
            codes = codes[1:]
        gram, _ = grams_of(np.concatenate([tail, codes]), np.zeros(1, np.int64))
        gram = gram[max(0, len(tail) - 1):]
        for lo in range(0, len(gram), SLICE_CHARS):
            total -= log_probabilities(model, gram[lo:lo + SLICE_CHARS]).sum(axis=0, dtype=np.float64)
        size, tail, last = size + len(gram), np.concatenate([tail, codes])[1 - ORDER:], part[-1]
    return total, np.array([size])


def _sums(model: Model, frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    for frame in batches_of(frames, "text", SLICE_CHARS):
        texts = [t or "" for t in frame.text.tolist()]
        if len(texts) > 1 or len(texts[0]) <= 2 * SLICE_CHARS:
            yield frame, *entropies(model, texts)
        else:
            yield frame, *_long_entropies(model, texts[0])


def verdicts(model: Model, total: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its score, its cross-entropy, and whether it is accepted."""
    per_symbol = total / np.maximum(size, 1)[:, None]
    best = per_symbol.argmin(axis=1)
    entropy = per_symbol[np.arange(len(best)), best]
    odds = -(total - total.min(axis=1, keepdims=True)) / model.temperature
    score = 1 / np.exp(odds).sum(axis=1)
    if model.most_entropy is None:
        return best, score, entropy, np.ones(len(best), dtype=bool)
    return best, score, entropy, (score >= model.least_score[best]) & (entropy <= model.most_entropy[best])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def _kept(level: DataFrame, langs: int, bound: int) -> tuple[pa.Table, pd.DataFrame]:
    """The n-grams of one order that the bound leaves (``lang, gram, n, total``, of the context), and how many have each count."""
    # Counts from 1024 on fall together by powers of two.
    bucket = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("long"))
    sizes = level.groupBy("lang", bucket.alias("bucket")).agg(F.count("*").alias("rows")).toPandas()
    least = F.get(F.array(*map(F.lit, _least_counts(sizes, langs, bound))), F.col("lang"))
    context = F.shiftrightunsigned("gram", 16).alias("context")
    totals = level.groupBy("lang", context).agg(F.sum("n").alias("total"))
    kept = level.filter(F.col("n") >= least).select("lang", "gram", "n", context)
    return kept.join(totals, ["lang", "context"]).select("lang", "gram", "n", "total").toArrow(), sizes


def train(docs: DataFrame) -> Model | None:
    """The model of all labelled training rows; None if there is none with a letter."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(
        ~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = rows.select("lang", "text").mapInPandas(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    scratch = Scratch(spark, "langid")
    counts = scratch.write(counts, "counts")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not langs:
        return None
    number = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")).cast("int") - 1
    # Lower orders count the distinct symbols before an n-gram.
    levels = {ORDER: scratch.write(counts.select(number.alias("lang"), "gram", "n"), f"level-{ORDER}")}
    scratch.drop("counts")
    for order in range(ORDER - 1, 0, -1):
        lower = F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1)).alias("gram")
        levels[order] = scratch.write(levels[order + 1].groupBy("lang", lower).agg(F.count("*").alias("n")), f"level-{order}")
    bound = max(1, MODEL_GRAMS // len(langs))
    model = _kneser_ney((_kept(levels[order], len(langs), bound) for order in range(1, ORDER + 1)), langs)
    scratch.drop(*[f"level-{order}" for order in levels])
    shared = spark.sparkContext.broadcast(model)

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, total, size in _sums(shared.value, frames):
            yield pd.DataFrame({"lang": frame.lang.to_numpy(), "total": list(total), "size": size})

    sums = scratch.write(rows.select(number.alias("lang"), "text").mapInPandas(measured, "lang int, total array<double>, size long").filter("size > 0"), "sums")
    shared.destroy()
    model = calibrated_on(model, sums)
    scratch.drop("sums")
    return model


def _losses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows and summed loss of each temperature."""
    loss = np.zeros(len(TEMPERATURES))
    n = 0
    for frame in frames:
        if len(frame):
            total, truth = np.stack(frame.total.to_numpy()), frame.lang.to_numpy()
            gap = -(total - total.min(axis=1, keepdims=True))
            for i, temperature in enumerate(TEMPERATURES):
                odds = gap / temperature
                loss[i] += (np.log(np.exp(odds).sum(axis=1)) - odds[np.arange(len(truth)), truth]).sum()
            n += len(frame)
    yield pd.DataFrame({"n": [n] * len(loss), "at": range(len(loss)), "loss": loss})


def _recognised(model: Model):
    """Score and entropy of the rows whose language is found."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                best, score, entropy, _ = verdicts(model, np.stack(frame.total.to_numpy()), frame["size"].to_numpy())
                right = best == frame.lang.to_numpy()
                yield pd.DataFrame({"lang": frame.lang.to_numpy()[right], "score": score[right], "entropy": entropy[right]})

    return run


def _limits(right: DataFrame) -> dict[int, tuple[float, float]]:
    """Per language the score below and the entropy above which REJECTED_SHARE of its rows lie, with some room. Exact quantiles,
    by rank: only the rows beyond them are ranked."""
    sizes = {r["lang"]: r["n"] for r in right.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    place = {lang: REJECTED_SHARE * (n - 1) for lang, n in sizes.items()}
    tails = {}
    for name, order in (("score", F.col("score")), ("entropy", F.col("entropy").desc())):
        first = top_per_key(right.select("lang", name), ["lang"], [order], k=int(max(place.values())) + 2, rank="rank")
        ends = [(F.col("lang") == lang) & F.col("rank").isin(int(at) + 1, int(at) + 2) for lang, at in place.items()]
        found = {(r["lang"], r["rank"]): r[name] for r in first.filter(reduce(or_, ends)).collect()}
        for lang, at in place.items():
            low = found[lang, int(at) + 1]
            tails[lang, name] = low + (found.get((lang, int(at) + 2), low) - low) * (at - int(at))
    return {lang: (tails[lang, "score"] / ROOM, tails[lang, "entropy"] * ROOM) for lang in sizes}


def calibrated_on(model: Model, sums: DataFrame) -> Model:
    """Temperature of least loss on all labelled rows (``lang, total, size``, a written table), and the limits that reject hardly any."""
    losses = sums.mapInPandas(_losses, "n long, at int, loss double").groupBy("at").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss")).collect()
    if not sum(r["n"] for r in losses):
        return model
    model.temperature = TEMPERATURES[min(losses, key=lambda r: (r["loss"], r["at"]))["at"]]
    fitted = Model(model.langs, [], [], [], [], model.floor, model.temperature)  # without the n-grams, which a verdict does not need
    right = sums.mapInPandas(_recognised(fitted), "lang int, score double, entropy double")
    own = _limits(right)
    if own:
        # A language without a recognised row takes the limits of all.
        every = _limits(right.withColumn("lang", F.lit(-1))) if len(own) < len(model.langs) else {}
        model.least_score, model.most_entropy = np.array([own.get(i) or every[-1] for i in range(len(model.langs))]).T
    return model


def calibrated(model: Model, sample: pd.DataFrame) -> Model:
    """``calibrated_on`` for a few labelled rows in memory."""
    if sample.empty:
        return model
    total, size = np.stack(sample.total.to_numpy()), sample["size"].to_numpy()
    truth = sample.lang.map({lang: i for i, lang in enumerate(model.langs)}).to_numpy()

    def loss(temperature: float) -> float:
        odds = -(total - total.min(axis=1, keepdims=True)) / temperature
        return float(np.mean(np.log(np.exp(odds).sum(axis=1)) - odds[np.arange(len(truth)), truth]))

    model.temperature = min(TEMPERATURES, key=loss)
    best, score, entropy, _ = verdicts(model, total, size)
    right = best == truth
    if right.any():
        limits = lambda own: (np.quantile(score[own], REJECTED_SHARE) / ROOM, np.quantile(entropy[own], 1 - REJECTED_SHARE) * ROOM)
        # A language without a recognised row in the sample takes the limits of all.
        own = [right & (truth == i) for i in range(len(model.langs))]
        model.least_score, model.most_entropy = np.array([limits(o if o.any() else right) for o in own]).T
    return model


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score``, ``entropy``, ``accepted``, in a struct ``row`` and beside it."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    texts = rows.select("row", whole_text("row.text").alias("text"))
    if model is None:
        return texts.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(False).alias("accepted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, entropy double, accepted boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        names = np.array([*own.langs, UNKNOWN], dtype=object)
        for batch in batches:
            out = []
            for _, total, size in _sums(own, iter([batch.to_frame("text")])):
                best, score, entropy, ok = verdicts(own, total, size)
                none = size == 0
                out.append(pd.DataFrame({
                    "lang_pred": names[np.where(none, len(own.langs), best)], "score": np.where(none, 0.0, score),
                    "entropy": np.where(none, np.nan, entropy), "accepted": ok & ~none}))
            yield pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=["lang_pred", "score", "entropy", "accepted"])

    # Taken as not repeatable, so that a filter on its answer does not work it out a second time.
    return texts.select("row", judge.asNondeterministic()("text").alias("judged")).select("row", "judged.*")
