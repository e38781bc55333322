"""Quality rules: counts that reject a text at once, then perplexity bands per language.

The language model is a modified Kneser-Ney model of 4-grams of symbols, counted by Spark over
all documents.  Bytes are spelled with 64 symbols and none is folded: most take one symbol, others
two, so the probability of a byte is that of its symbols one after the other.  The model is stored
as sorted arrays of n-gram keys with probabilities and back-off weights.  It grows with the corpus;
a language with many n-grams is cut into ranges of the two symbols before the predicted one, so a
task holds a few million at once whatever the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.llm.text import BLANK_WORD, Rolling, Texts, covered, ragged, steps, table
from loanloom.session import stage

ORDER, BITS = 4, 6
#: N-grams that a task holds before it hands them on; bytes of text whose symbols are worked on at once.
HELD, STEP = 2_000_000, 1 << 20
#: Values of the two symbols before the predicted one; n-grams of at most that many symbols go everywhere.
PIECES, EVERYWHERE = 1 << 2 * BITS, 2
_SIGNS = np.zeros(256, dtype=bool)
_SIGNS[list(b"#*$%&|<>")] = True

_NONE = 255
_COMMON = b"abcdefghijklmnopqrstuvwxyz0123456789 \n.,;:!?'\"-()"
_SHIFT, _OTHER, _LEAD = range(len(_COMMON) + 1, len(_COMMON) + 4)
_OWN_LEADS = b"\xc2\xc3\xd0\xd1\xe3\xe4\xe5\xe6\xe7\xe8\xe9"


def _symbols() -> np.ndarray:
    """One or two symbols of each byte; 0 stands before a text too.

    Tail bytes are their six bits: that they follow a lead byte tells them from other symbols.  Leads
    of accents, Cyrillic, kana and most Chinese characters take one symbol as well.
    """
    out = np.full((256, 2), _NONE, dtype=np.uint8)
    out[list(_COMMON), 0] = np.arange(1, len(_COMMON) + 1)
    for letter in range(26):
        out[ord("A") + letter] = _SHIFT, letter + 1
    others = np.flatnonzero(out[:0x80, 0] == _NONE)
    out[others, 0], out[others, 1] = _OTHER, np.arange(len(others))
    tail, lead = np.arange(0x80, 0xC0), np.arange(0xC0, 0x100)
    out[tail, 0] = tail & 63
    out[lead, 0], out[lead, 1] = _LEAD, lead & 63
    out[list(_OWN_LEADS)] = [[i, _NONE] for i in range(_LEAD + 1, 64)]
    return out


SYMBOLS = _symbols()


def spelled(texts: Texts) -> Texts:
    """The symbols of some texts."""
    pairs = SYMBOLS[texts.data]
    there = pairs != _NONE
    ends = np.cumsum(1 + there[:, 1], dtype=np.int64)
    return Texts(pairs[there], np.append(0, ends)[texts.offsets])


def grams(symbols: Texts) -> np.ndarray:
    """Key of the n-gram that ends at each symbol: ``ORDER`` symbols, earlier ones higher."""
    keys, wide = symbols.data.astype(np.int64), 1
    while wide < ORDER:  # so many symbols are in a key
        more = min(wide, ORDER - wide)
        before = keys[:-wide] & ((1 << BITS * more) - 1)
        before <<= BITS * wide
        keys[wide:] |= before
        wide += more
    # no key reaches into the text before
    starts, sizes = symbols.offsets[:-1], np.diff(symbols.offsets)
    for place in range(ORDER - 1):
        keys[starts[sizes > place] + place] &= (1 << BITS * (place + 1)) - 1
    return keys


def _merged(some: tuple[np.ndarray, np.ndarray], more: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of two such lists together."""
    keys, n = (np.concatenate(two) for two in zip(some, more, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


def count_grams(docs: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n``: every n-gram of every text, merged per task and then per key."""

    def run(batches):
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for part, some in steps(batch, limit=STEP):
                symbols = spelled(some)
                keys = grams(symbols)
                names = np.array(part.column("lang").to_pylist(), dtype=object)
                sizes = np.diff(symbols.offsets)
                for lang in set(names.tolist()):
                    own = np.unique(keys[np.repeat(names == lang, sizes)], return_counts=True)
                    totals[lang] = _merged(totals[lang], own) if lang in totals else own
                    # many languages or n-grams: hand on what there is
                    if len(totals) > 256 or sum(len(k) for k, _ in totals.values()) > HELD:
                        yield from _handed(totals)
                        totals = {}
        yield from _handed(totals)

    return docs.mapInArrow(run, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))


def _handed(totals):
    for lang, (keys, n) in totals.items():
        for a in range(0, len(keys), 1 << 16):
            part = keys[a:a + (1 << 16)]
            yield table(lang=pa.array([lang] * len(part), pa.string()), gram=part, n=n[a:a + (1 << 16)])


def _discounts(counts: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts of each language, from how many n-grams occur 1 to 4 times."""
    times = [F.sum((F.col("n") == i).cast("double")).alias(f"t{i}") for i in range(1, 5)]
    some = counts.groupBy("lang").agg(*times)
    y = F.when(F.col("t1") > 0, F.col("t1") / (F.col("t1") + 2 * F.col("t2"))).otherwise(0.5)

    def d(i):
        raw = i - (i + 1) * F.col("y") * F.col(f"t{i + 1}") / F.greatest(F.col(f"t{i}"), F.lit(1.0))
        # with few n-grams the estimate leaves its range
        return F.greatest(F.lit(0.1), F.least(F.lit(i - 0.1), raw)).alias(f"d{i}")

    return some.withColumn("y", y).select("lang", d(1), d(2), d(3))


def _level(counts: DataFrame, order: int) -> DataFrame:
    """``lang``, ``size``, ``gram``, its discounted share ``p`` and the ``back``-off mass of its context."""
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = with_languages(counts, stage(_discounts(counts), "discounts")).withColumn("cut", discount).withColumn(
        "context", F.shiftright("gram", BITS))
    totals = rows.groupBy("lang", "context").agg(F.sum("n").alias("all"), F.sum("cut").alias("held"))
    return rows.join(totals, ["lang", "context"]).select(
        "lang", F.lit(order).alias("size"), "gram", ((F.col("n") - F.col("cut")) / F.col("all")).alias("p"),
        (F.col("held") / F.col("all")).alias("back"))


def fit(docs: DataFrame) -> DataFrame:
    """The model: ``lang``, ``size`` (1 to ``ORDER``), ``gram``, ``p`` and ``back`` mass of its context.

    The highest order uses counts, lower ones the number of distinct symbols seen before an
    n-gram.
    """
    counts = stage(count_grams(docs), "gram-counts")
    levels = _level(counts, ORDER)
    for order in range(ORDER - 1, 0, -1):
        mask = (1 << BITS * order) - 1
        counts = stage(counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(
            F.count("*").alias("n")), "gram-counts")
        levels = levels.unionByName(_level(counts, order))
    return stage(levels, "model")


class Model:
    """Sorted n-gram keys of one language with interpolated log probabilities and back-off masses."""

    def __init__(self, size: np.ndarray, gram: np.ndarray, p: np.ndarray, back: np.ndarray):
        self.keys, self.full, self.contexts, self.masses = [], [], [], []
        for order in range(1, ORDER + 1):
            own = size == order
            sort = np.argsort(gram[own])
            keys, share, mass = gram[own][sort].astype(np.int64), p[own][sort], back[own][sort]
            contexts, first = np.unique(keys >> BITS, return_index=True)
            lower = self._lower(keys, order)
            self.keys.append(keys)
            self.full.append(share + mass * lower)
            self.contexts.append(contexts)
            self.masses.append(mass[first])
        #: Hash table of places in the keys of the highest order, made where it is used.
        self.slots: np.ndarray | None = None

    def _lower(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Probability of the last symbol after a context that is one symbol shorter."""
        if order == 1:
            return np.full(len(keys), 1.0 / (1 << BITS))
        return self.of(keys & ((1 << BITS * (order - 1)) - 1), order - 1)

    def of(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Probability of the last symbol of each key after the symbols before it."""
        keys, known = np.asarray(keys, np.int64), self.keys[order - 1]
        if not len(known):
            return self._lower(keys, order)
        at = self._places(keys) if order == ORDER else np.minimum(np.searchsorted(known, keys), len(known) - 1)
        out = self.full[order - 1][at]
        new = np.flatnonzero(known[at] != keys)
        if len(new):
            context = keys[new] >> BITS
            there = self.contexts[order - 1]
            at = np.minimum(np.searchsorted(there, context), len(there) - 1)
            mass = np.where(there[at] == context, self.masses[order - 1][at], 1.0)
            out[new] = mass * self._lower(keys[new], order)
        return out

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        size = max(4, (2 * len(self.keys[-1])).bit_length())
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size)).view(np.int64)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is among those of the highest order; any place for others."""
        known = self.keys[-1]
        if self.slots is None:
            self.slots = np.full(1 << max(4, (2 * len(known)).bit_length()), -1, np.int32)
            left, slot = np.arange(len(known)), self._slot(known)
            while len(left):
                free = self.slots[slot] < 0
                self.slots[slot[free]] = left[free]
                lost = self.slots[slot] != left
                left, slot = left[lost], (slot[lost] + 1) & (len(self.slots) - 1)
        slot = self._slot(keys)
        at = self.slots[slot]
        left = np.flatnonzero(known[at] != keys)
        while len(left := left[at[left] >= 0]):
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)
            at[left] = self.slots[slot[left]]
            left = left[known[at[left]] != keys[left]]
        return at


def base_counts(some) -> dict[str, np.ndarray]:
    """Counts of words, characters, signs, repeated lines and repeated words of each text."""
    words = some.words(BLANK_WORD)
    inside = np.zeros(len(some.data) + 1, dtype=np.int32)
    np.add.at(inside, words.starts, 1)
    np.add.at(inside, words.stops, -1)
    lead = (np.cumsum(inside[:-1]) > 0) & ((some.data & 0xC0) != 0x80)
    sums = lambda flags: np.diff(np.append(0, np.cumsum(flags))[some.offsets])
    n_words = words.counts()
    lines = []
    for i in range(len(some)):
        own = [x for x in some.bytes_of(i).split(b"\n") if x.strip(b" \t\n\r\v\f")]
        lines.append(len(own) - len(set(own)))
    hashes = words.hashes()
    windows = np.maximum(n_words - 2, 0)
    start = ragged(words.offsets[:-1], windows)
    grams3 = Rolling(hashes, 1).ranges(start, start + 3)
    text = np.repeat(np.arange(len(some)), windows)
    order = np.lexsort((grams3, text))
    same = np.zeros(len(order) + 1, dtype=bool)
    same[1:-1] = (grams3[order][1:] == grams3[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = start[order[same[1:] | same[:-1]]]
    repeated = np.append(0, np.cumsum(covered(len(hashes), twice, twice + 3)))
    return {"n_words": n_words, "word_chars": sums(lead), "n_symbols": sums(_SIGNS[some.data]),
            "n_dup_lines": np.array(lines, dtype=np.int64), "n_repeat_words": np.diff(repeated[words.offsets])}


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def score(docs: DataFrame, model: DataFrame, block: int = 1_000_000, cut: int = 3_000_000) -> DataFrame:
    """``docs`` (``lang``, ``text`` and others) without the text, plus counts and ``entropy``,
    the mean negative log probability of a byte (0 for empty texts).

    Languages are scored in blocks whose models have at most ``block`` n-grams together, or one
    language.  A language with more than ``cut`` is scored in several turns, each with the n-grams
    of a range of last two symbols before the predicted one; the turns' sums are added.
    """
    sizes = {r["lang"]: r["count"] for r in model.groupBy("lang").count().collect()}
    blocks: list[list[str]] = []
    room = 0
    for lang in sorted(x for x in sizes if sizes[x] <= cut):
        if not blocks or sizes[lang] > room:
            blocks.append([])
            room = block
        blocks[-1].append(lang)
        room -= sizes[lang]
    # texts of a language without a model are empty: no n-gram was counted
    large = [x for x in sorted(sizes) if sizes[x] > cut]
    known = F.col("lang").isin(list(sizes)) if sizes else F.lit(False)
    out = _scored(docs, model, [], 0, PIECES) if not sizes else None
    for i, langs in enumerate(blocks or [[]] * bool(large)):
        own = docs if len(blocks) == 1 and not large else docs.filter(
            F.col("lang").isin(langs) | (~known if i == 0 else F.lit(False)))
        scored = _scored(own, model, langs, 0, PIECES)
        out = scored if out is None else out.unionByName(scored)
    for lang in large:
        own = stage(docs.filter(F.col("lang") == lang).withColumn("__number", F.monotonically_increasing_id()), "numbered")
        first, *rest = _ranges(model, lang, cut)
        scored = stage(_scored(own, model, [lang], *first), "turn")
        sums = scored.select("__number", "entropy")
        for turn in rest:
            sums = sums.unionByName(_scored(
                own.select("__number", "lang", "text"), model, [lang], *turn, counted=False).select("__number", "entropy"))
        sums = sums.groupBy("__number").agg(F.sum("entropy").alias("entropy"))
        out = out.unionByName(scored.drop("entropy").join(sums, "__number").drop("__number"))
    return out


def _piece():
    """The two symbols before the predicted one."""
    return F.shiftright("gram", BITS).bitwiseAND(F.lit(PIECES - 1))


def _ranges(model: DataFrame, lang: str, cut: int) -> list[tuple[int, int]]:
    """Ranges of pieces of a language with about ``cut`` n-grams each, or one piece."""
    found = model.filter((F.col("lang") == lang) & (F.col("size") > EVERYWHERE)).groupBy(
        _piece().cast("int").alias("piece")).count().orderBy("piece").collect()
    starts, held = [0], 0
    for r in found:
        if held and held + r["count"] > cut:
            starts.append(r["piece"])
            held = 0
        held += r["count"]
    return list(zip(starts, [*starts[1:], PIECES], strict=True))


def _scored(docs: DataFrame, model: DataFrame, langs: list[str], low: int, high: int, counted: bool = True) -> DataFrame:
    """``docs`` scored by the models of some languages, over symbols whose piece is in a range."""
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType(list(rest))
    for c in COUNTS if counted else []:
        schema = schema.add(c, "long")
    schema = schema.add("entropy", "double")
    models = {}
    if langs:
        own = model.filter(F.col("lang").isin(langs))
        if (low, high) != (0, PIECES):
            own = own.filter((F.col("size") <= EVERYWHERE) | ((_piece() >= low) & (_piece() < high)))
        place = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")).cast("int")
        arrays = own.select(place.alias("place"), F.col("size").cast("tinyint"), "gram", "p", "back").toArrow()
        place, *columns = (arrays[c].to_numpy() for c in ("place", "size", "gram", "p", "back"))
        del arrays
        models = {x: Model(*(v[place == i] for v in columns)) for i, x in enumerate(langs, 1)}
    shared = docs.sparkSession.sparkContext.broadcast(models)
    return docs.mapInArrow(_scorer(shared, [f.name for f in rest], low, high, counted), schema)


def _scorer(shared, names, low, high, counted):
    def run(batches):
        models = shared.value
        for batch in batches:
            for part, some in steps(batch, limit=STEP):
                symbols = spelled(some)
                keys, logs = grams(symbols), np.zeros(len(symbols.data))
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                sizes = np.diff(symbols.offsets)
                for lang in set(langs.tolist()):
                    if lang not in models:
                        continue
                    own = np.repeat(langs == lang, sizes)
                    if (low, high) != (0, PIECES):
                        here = (keys >> BITS) & (PIECES - 1)
                        own &= (here >= low) & (here < high)
                    if own.all():
                        logs = -np.log(models[lang].of(keys))
                    else:
                        logs[own] = -np.log(models[lang].of(keys[own]))
                total = np.diff(np.append(0, np.cumsum(logs))[symbols.offsets])
                counts = base_counts(some) if counted else {}
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [pa.array(n.astype(np.int64)) for n in counts.values()]
                    + [pa.array(total / np.maximum(np.diff(some.offsets), 1))], names=[*names, *counts, "entropy"])

    return run


def bands(scored: DataFrame, width: float = 6.0, least: float = 0.05) -> DataFrame:
    """``lang``, ``low`` and ``high`` entropy: the median and ``width`` times the median
    deviation (``least`` at least) on both sides, over documents that pass the base rules.

    ``least`` is for languages whose documents are mostly copies, without a deviation of their own.
    """
    good = scored.filter("NOT base_failed")
    middle = stage(good.groupBy("lang").agg(
        F.percentile_approx("entropy", F.lit(0.5), F.lit(10_000)).alias("middle")), "middles")
    spread = with_languages(good, middle).groupBy("lang", "middle").agg(F.percentile_approx(
        F.abs(F.col("entropy") - F.col("middle")), F.lit(0.5), F.lit(10_000)).alias("spread"))
    reach = F.greatest(F.lit(least), width * F.col("spread"))
    return stage(spread.select(
        "lang", (F.col("middle") - reach).alias("low"), (F.col("middle") + reach).alias("high")), "bands")


def with_languages(rows: DataFrame, languages: DataFrame, most: int = 10_000) -> DataFrame:
    """``rows`` with what ``languages`` says; up to ``most`` languages go to every task."""
    if languages.count() <= most:
        languages = F.broadcast(languages)
    return rows.join(languages, "lang", "left")


def judge(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Every row's ``carry`` columns (in ``carried``) with its counts, ``base_failed``, ``perplexity`` (a byte's)
    and ``kept``; ``docs`` has ``lang`` and ``text``.

    A text fails the base rules with fewer than 50 words, or if more than half of them lie in
    3-word windows that the text has twice.  What passes is kept if its perplexity lies in the
    band of its language.  Null language counts as the language ``''``; null text as empty.
    Repeated rows and rows without id are judged like any other; an empty table stays empty.
    """
    texts = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                        F.col("text").cast("string").alias("text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = stage(score(texts, fit(texts.select("lang", "text"))).withColumn("base_failed", failed), "scored")
    banded = with_languages(scored, bands(scored))
    fits = F.coalesce(F.col("entropy").between(F.col("low"), F.col("high")), F.lit(False))
    return banded.select("carried", *COUNTS, "base_failed", F.exp("entropy").alias("perplexity"),
                         (~F.col("base_failed") & fits).alias("kept"))


def filtered(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are kept, with all their columns."""
    return judge(docs, docs.columns).filter("kept").select("carried.*")
