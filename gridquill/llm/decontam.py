"""Benchmark decontamination by template canonicalisation.

Tokens of benchmark items and documents become templates: numbers (digits or words), units next to
numbers, and names (capitalised words) turn into typed placeholders, a run of one type into one.
Windows of five template tokens are joined by hash. An item and a document can only agree in half of the
item's windows if they share one of its rarest, so only those make candidates; a window that many items
have makes none by itself. The windows of a candidate are put in alignments (equal distance between
item and document, small shifts by inserted or missing words included). Along an alignment, a value in
the item's slots must always stand for one value in the document's slots. Where it
doesn't, windows count only with the item's own value, or else with the one value that most of its
slots have; the others are dropped. Alignments count together only as far as they agree in all
values. So a question with other numbers and names is found, while text that
only looks alike isn't. A second template without names finds copies in other letter case.

Items without any such window (too short, or nothing but names and numbers) are matched by their exact
tokens, all of them in one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import let
from .common import Scratch, fits, read_table, small, workers_see_package
from .textvec import LOWER, U, Words, constants, lower_latin, mix, powers, text_slices, utf8

WIDTH = 5
#: A document is contaminated by an item if at least this share of the item's windows is in it.
COVERAGE = 0.5
#: Literal tokens that a window must have, so that placeholders alone match nothing.
LITERALS = 2
#: Tokens of a window of exact tokens. Items of fewer tokens match only documents that are the item alone.
EXACT = 4
#: Diagonals (place in the document less place in the item) no farther apart than this are one alignment.
GAP = 8
#: Bytes of benchmark windows that go to every task; beyond it document windows meet them in a shuffle.
BROADCAST_WINDOWS = 32 << 20
WITHOUT_NAMES, WITH_NAMES, TOKENS = range(3)

#: Fixed values, by language: en, fr, de, es. Articles that are number words, too, are left out.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half "
    "zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante cent mille milliard douzaine moitié "
    "null zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend "
    "dutzend hälfte cero dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien ciento mil docena mitad"
).split()
UNIT_WORDS = (
    "% $ € £ percent dollar dollars euro euros pound pounds cent cents mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams "
    "kilogram kilograms ounce ounces oz lb lbs ton tons ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours hr "
    "day days week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres degrees mph kmh hz khz mhz ghz w kw v "
    "pourcent livre livres centime centimes mètre mètres kilomètre kilomètres gramme grammes kilo kilos tonne tonnes seconde secondes heure heures jour jours semaine semaines mois an ans année années degrés "
    "prozent pfund meile meilen gramm kilogramm tonnen sekunde sekunden minuten stunde stunden tag tage woche wochen monat monate jahr jahre grad "
    "dólar dólares libra libras céntimos metro metros kilómetro kilómetros milla millas gramo gramos kilogramo kilogramos tonelada toneladas litro litros segundo segundos minuto minutos hora horas día días semana semanas mes meses año años grados"
).split()

_DIGIT = np.array([48 <= b < 58 for b in range(256)])
_SIGN = np.array([chr(b) in "%$" for b in range(256)])
_PUNCTUATION = np.array([33 <= b < 127 and not chr(b).isalnum() and chr(b) not in "%$" for b in range(256)])
_POINT = np.array([chr(b) in ".," for b in range(256)])
LITERAL, NUMBER, UNIT, NAME = range(4)
_PLACEHOLDER = constants(424242, 4)


def _vocabulary(words: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array(words))
    return np.sort(Words(data, offsets, LOWER).hash)


_NUMBERS, _UNITS = _vocabulary(NUMBER_WORDS), _vocabulary(UNIT_WORDS)


def _within(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words without punctuation, cut where digits meet other characters, and the type of each."""
    plain = lower_latin(data)
    inner = np.zeros(len(data), bool)
    if len(data) > 2:
        inner[1:-1] = _POINT[data[1:-1]] & _DIGIT[data[:-2]] & _DIGIT[data[2:]]
    plain[_PUNCTUATION[data] & ~inner] = 32
    kind = np.where(_DIGIT[plain] | inner, 1, np.where(_SIGN[plain], 2, 0)).astype(np.int8)
    breaks = np.zeros(len(data), bool)
    breaks[1:] = kind[1:] != kind[:-1]
    words = Words(plain, offsets, LOWER, breaks=breaks)
    kinds = np.zeros(len(words.hash), np.int8)
    if not len(kinds):
        return words, kinds
    first, second = data[words.start], data[np.minimum(words.start + 1, len(data) - 1)]
    upper = lambda b: (b >= 65) & (b <= 90)
    # Capital letters of Latin-1 are the bytes C3 80 to C3 9E in UTF-8.
    name = np.where(first == 0xC3, (second >= 0x80) & (second <= 0x9E), upper(first) & ~upper(second)) & (words.length > 1)
    kinds[name] = NAME
    kinds[_DIGIT[first] | _within(words.hash, _NUMBERS)] = NUMBER
    number = kinds == NUMBER
    beside = np.zeros(len(kinds), bool)
    same = words.doc[1:] == words.doc[:-1]
    beside[1:] |= number[:-1] & same
    beside[:-1] |= number[1:] & same
    kinds[beside & ~number & _within(words.hash, _UNITS)] = UNIT
    return words, kinds


def template_windows(words: Words, kinds: np.ndarray, names: bool, width: int = WIDTH) -> dict[str, np.ndarray]:
    """Windows of one template: text row, position of the first token, hash, and slot values (flat, with bounds).

    A window has LITERALS literal tokens at least. A text of fewer tokens than width has one window, its whole
    sequence, that equals only whole sequences.
    """
    kinds = kinds if names else np.where(kinds == NAME, LITERAL, kinds)
    n = len(kinds)
    keep = np.ones(n, bool)
    keep[1:] = (kinds[1:] == LITERAL) | (kinds[1:] != kinds[:-1]) | (words.doc[1:] != words.doc[:-1])
    at = np.flatnonzero(keep)
    if not n:
        none = np.zeros(0, np.int64)
        return {"row": none, "pos": none, "h": none, "start": none, "length": none, "kind": none, "value": none}
    # The order inside of a run counts.
    inside = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    value = np.add.reduceat(words.hash * powers(int(inside.max()) + 1)[inside], at)
    kind, doc = kinds[at], words.doc[at]
    symbol = np.where(kind == LITERAL, value, _PLACEHOLDER[kind])
    seed = 31 if names else 32
    m = len(at) - width + 1
    starts = [np.zeros(0, np.int64)]
    hashes = [np.zeros(0, U)]
    lengths = [np.zeros(0, np.int64)]
    if m > 0:
        total, literal = np.zeros(m, U), np.zeros(m, np.int8)
        for k, c in enumerate(constants(seed, width)):
            total += symbol[k : k + m] * c
            literal += kind[k : k + m] == LITERAL
        good = np.flatnonzero((doc[:m] == doc[width - 1 :]) & (literal >= LITERALS))
        starts.append(good)
        hashes.append(mix(total[good]))
        lengths.append(np.full(len(good), width))
    first = np.searchsorted(doc, np.arange(len(words.count) + 1))
    for row in np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < width)):
        a, b = first[row], first[row + 1]
        if (kind[a:b] == LITERAL).sum() < LITERALS:
            continue
        starts.append(np.array([a]))
        hashes.append(mix((symbol[a:b] * constants(seed + 100 * int(b - a), int(b - a))).sum(keepdims=True, dtype=U)))
        lengths.append(np.array([b - a]))
    start, length = np.concatenate(starts), np.concatenate(lengths)
    return {"row": doc[start], "pos": start - first[doc[start]], "h": np.concatenate(hashes).view(np.int64), "start": start, "length": length, "kind": kind, "value": value.view(np.int64)}


def exact_windows(words: Words) -> dict[str, np.ndarray]:
    """Windows of EXACT tokens as they are, or of all tokens of a text of fewer; they have no slots."""
    n = len(words.hash)
    m = max(0, n - EXACT + 1)
    total = np.zeros(m, U)
    for k, c in enumerate(constants(33, EXACT)):
        total += words.hash[k : k + m] * c
    good = np.flatnonzero(words.doc[:m] == words.doc[n - m :]) if m else np.zeros(0, np.int64)
    starts, hashes, lengths = [good], [mix(total[good])], [np.full(len(good), EXACT)]
    for row in np.flatnonzero((words.count > 0) & (words.count < EXACT)):
        size = int(words.count[row])
        starts.append(words.first[row : row + 1])
        hashes.append(mix((words.hash[words.first[row] :][:size] * constants(133 + size, size)).sum(keepdims=True, dtype=U)))
        lengths.append(np.array([size]))
    start = np.concatenate(starts)
    row = words.doc[start]
    return {"row": row, "pos": start - words.first[row], "h": np.concatenate(hashes).view(np.int64), "start": start, "length": np.concatenate(lengths), "kind": np.zeros(n, np.int8), "value": words.hash.view(np.int64)}


def _picked(found: dict[str, np.ndarray], pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """(row, position, hash, slot values and slot positions as list arrays) of the picked windows."""
    if not len(pick):
        return *(np.zeros(0, np.int64),) * 3, *(pa.array([], pa.list_(pa.int64())),) * 2
    slot = np.flatnonzero(found["kind"] != LITERAL)
    low, high = np.searchsorted(slot, found["start"][pick]), np.searchsorted(slot, found["start"][pick] + found["length"][pick])
    bounds = np.concatenate([[0], np.cumsum(high - low)])
    flat = np.arange(bounds[-1]) - np.repeat(bounds[:-1], high - low) + np.repeat(low, high - low)
    at = slot[flat] if len(flat) else np.zeros(0, np.int64)
    first = np.repeat((found["start"] - found["pos"])[pick], high - low)
    lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v)) for v in (found["value"][at], at - first)]
    return found["row"][pick], found["pos"][pick], found["h"][pick], *lists


def windows_of(rows: DataFrame, keys: tuple[str, ...], known: np.ndarray | None, items: bool, width: int = WIDTH) -> DataFrame:
    """The named columns, template, pos, h, slots and slot positions of the rows' windows; with known, only of windows in that
    sorted array. Items have windows of exact tokens only where they have no others, documents have them all."""
    kept = rows.select(*keys, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches):
            words, kinds = tokens(data, offsets)
            made = [template_windows(words, kinds, False, width), template_windows(words, kinds, True, width), exact_windows(words)]
            has = np.zeros(part.num_rows, bool)
            for regular in made[:TOKENS]:
                has[regular["row"][regular["length"] == width]] = True
            for template, found in enumerate(made):
                pick = np.arange(len(found["h"])) if known is None else np.flatnonzero(_within(found["h"], known))
                if items and template == TOKENS:
                    pick = pick[~has[found["row"][pick]]]
                row, pos, h, slots, slot_at = _picked(found, pick)
                if len(row):
                    own = [c.take(pa.array(row)) for c in part.columns[:-1]]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(row), template, np.int32)), pa.array(pos), pa.array(h), slots, slot_at], [*keys, "template", "pos", "h", "slots", "slot_at"])

    shape = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in keys)
    return kept.mapInArrow(run, f"{shape}, template int, pos long, h long, slots array<long>, slot_at array<long>")


def _consistent(found: Column) -> Column:
    """Those windows (item_pos, bound) of one alignment in which every item value has the document value that stands for it.

    That is its only one, else the item's own, else the one in more of the item's slots than any other; if none is, its windows go.
    """
    pair = lambda b: F.struct(b["item_slots"].alias("i"), b["slots"].alias("d"))
    rival = lambda p, q: (q["i"] == p["i"]) & (q["d"] != p["d"]) & ((q["d"] == q["i"]) | (q["n"] >= p["n"]))

    def kept(f: Column) -> Column:
        return let(F.transform(F.array_distinct(F.flatten(f["bound"])), pair), lambda every: let(F.array_distinct(every), lambda distinct: chosen(f, every, distinct)))

    def chosen(f: Column, every: Column, distinct: Column) -> Column:
        single = F.size(distinct) == F.size(F.array_distinct(F.transform(distinct, lambda p: p["i"])))
        counted = F.transform(distinct, lambda p: F.struct(p["i"].alias("i"), p["d"].alias("d"), F.size(F.filter(every, lambda q: q == p)).alias("n")))
        return F.when(single, f).otherwise(let(counted, lambda c: let(leading(c), lambda held: F.filter(f, lambda w: F.forall(w["bound"], lambda b: F.array_contains(held, pair(b)))))))

    def leading(c: Column) -> Column:
        return F.transform(F.filter(c, lambda p: (p["i"] == p["d"]) | ~F.exists(c, lambda q: rival(p, q))), lambda p: F.struct(p["i"].alias("i"), p["d"].alias("d")))

    return let(found, kept)


def contamination(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, coverage: float = COVERAGE, width: int = WIDTH) -> DataFrame:
    """Pairs of documents and benchmark items found in them.

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored. Null and empty texts match
    nothing. An item without a window (see the module) matches where all its tokens stand in a row, one of
    fewer than EXACT tokens only a document of these tokens and no others. A short item with LITERALS literal tokens
    also matches a document whose whole template equals its own.
    Documents and items are told apart by id and text, so null or repeated ids don't mix. No rows on either side:
    no rows out. Items or documents that are equal each get their own pairs.

    Returns doc_id, text_key (hash of the text), item_id, covered, windows, reparameterised.
    """
    workers_see_package(docs.sparkSession)
    named = benchmark.select("item_id", F.xxhash64("text").alias("item_key"), "text")
    items = scratch.table(windows_of(named, ("item_id", "item_key"), None, True, width).distinct(), "items")
    few = fits(items, BROADCAST_WINDOWS)
    sent = F.broadcast if few else lambda df: df
    item = [F.col("item_id"), F.col("item_key"), F.col("template")]
    needed = F.when(F.col("template") == TOKENS, F.col("windows")).otherwise(F.greatest(F.ceil(F.col("windows") * coverage), F.lit(1)))
    totals = items.groupBy(*item).agg(F.count("*").alias("windows")).withColumn("needed", needed)
    known = np.unique(items.select("h").toArrow()["h"].to_numpy()) if few else None
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = windows_of(keyed, ("doc_id", "text_key"), known, False, width).drop("slot_at")
    if few:
        found = scratch.table(found, "found")
    # An item that is there with all the windows it needs shares one of its rarest windows - needed + 1 windows.
    spread = items.groupBy("template", "h").agg(F.count_distinct("item_id", "item_key").alias("df"))
    ranked = items.join(spread, ["template", "h"]).withColumn("rank", F.row_number().over(W.partitionBy(*item).orderBy("df", "h", "pos")))
    rare = _with_totals(ranked, totals).where(F.col("rank") <= F.col("windows") - F.col("needed") + 1).select("item_id", "item_key", "template", "h").distinct()
    candidates = found.select("doc_id", "text_key", "template", "h").distinct().join(sent(rare), ["template", "h"]).select("doc_id", "text_key", "template", "item_id", "item_key").distinct()
    own = candidates.select(*[F.col(c).alias(f"c_{c}") for c in candidates.columns])
    met = found.join(own, (F.col("template") == F.col("c_template")) & (F.col("text_key") == F.col("c_text_key")) & F.col("doc_id").eqNullSafe(F.col("c_doc_id")))
    met = met.select("doc_id", "text_key", "template", "h", "pos", "slots", F.col("c_item_id").alias("item_id"), F.col("c_item_key").alias("item_key"))
    side = items.select(F.col("item_id").alias("i_id"), F.col("item_key").alias("i_key"), F.col("template").alias("i_template"), F.col("h").alias("i_h"), F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"), "slot_at")
    pairs = met.join(sent(side), (F.col("h") == F.col("i_h")) & (F.col("template") == F.col("i_template")) & (F.col("item_key") == F.col("i_key")) & F.col("item_id").eqNullSafe(F.col("i_id")))
    pair = ["doc_id", "text_key", "item_id", "item_key", "template"]
    placed = pairs.select(*pair, (F.col("pos") - F.col("item_pos")).alias("diagonal"), F.struct("item_pos", F.arrays_zip("slot_at", "item_slots", "slots").alias("bound")).alias("w"))
    step = F.col("diagonal") - F.lag("diagonal").over(W.partitionBy(*pair).orderBy("diagonal"))
    apart = F.coalesce(step > F.when(F.col("template") == TOKENS, 0).otherwise(GAP), F.lit(False)).cast("int")
    aligned = placed.withColumn("apart", apart).withColumn("alignment", F.sum("apart").over(W.partitionBy(*pair).orderBy("diagonal")))
    each = aligned.groupBy(*pair, "alignment").agg(F.collect_set("w").alias("found"))
    # The best alignment alone, or all of them as far as they agree.
    each = each.withColumn("one", let(_consistent(F.col("found")), _judged))
    every = each.groupBy(*pair).agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("windows_met"), F.max("one").alias("one"), F.count("*").alias("alignments"))
    together = F.when((F.col("template") != TOKENS) & (F.col("alignments") > 1), let(_consistent(F.col("windows_met")), _judged))
    both = every.withColumn("best", F.greatest("one", together)).drop("windows_met", "one", "alignments")
    judged = _with_totals(both, totals).where(F.col("best.covered") >= F.col("needed"))
    # A copy found without names is no re-parameterised one, whatever the other template says.
    return judged.groupBy("doc_id", "text_key", "item_id").agg(
        F.max("best.covered").alias("covered"), F.max("windows").alias("windows"), F.min(~F.col("best.verbatim")).alias("reparameterised")
    )


def _judged(found: Column) -> Column:
    """(covered, verbatim) of consistent windows: how many of the item's are there, and whether all slots have the item's values."""
    same = F.forall(found, lambda w: F.forall(w["bound"], lambda b: b["item_slots"] == b["slots"]))
    return F.struct(F.size(F.array_distinct(F.transform(found, lambda w: w["item_pos"]))).alias("covered"), same.alias("verbatim"))


def _with_totals(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """rows with windows and needed of their item's template; null ids are equal here."""
    named = small(totals.select(F.col("item_id").alias("t_id"), F.col("item_key").alias("t_key"), F.col("template").alias("t_template"), "windows", "needed"))
    on = F.col("item_id").eqNullSafe(F.col("t_id")) & (F.col("item_key") == F.col("t_key")) & (F.col("template") == F.col("t_template"))
    return rows.join(named, on).drop("t_id", "t_key", "t_template")


def decontaminate(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """docs without the documents that contain a benchmark item; columns stay."""
    bad = scratch.table(contamination(docs, benchmark, scratch).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "contaminated")
    return docs.join(small(bad), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left_anti")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), Scratch(spark, "op2"))
    return found.select("doc_id", "item_id", F.col("covered").cast("long").alias("covered"), F.col("windows").cast("long").alias("windows"), "reparameterised")
