"""Problem 1: statistics per page that tell prose from lists, tables and junk.

1. Over the main body's lines, headings apart, lists and tabular rows are told by their form; the rest is measured:
   words known from sentences of the corpus, repetition of word pairs, symbols, digits, word lengths, line ends.
2. Each statistic, the shares of the forms among them, gets its exact rank among the reference of its language label:
   the distinct texts of which no form fills more than half, so that neither copies nor much junk move a rank. Distinct
   values with their counts are range-partitioned and sorted, counted within each partition, and shifted by the counts
   of the partitions before; ties share a rank. Values are ranked as measured, neither rounded nor capped.
3. The empirical tail probabilities are combined into an outlier score (sum of negative logarithms), which is ranked
   against the scores of the reference in the same way (score_tail).
4. A page is a case if its score stands out (score_tail at most OUTLYING) and one kind fills more than half of its
   characters; that kind is its class. Text is junk where its words say nothing or only repeat. A language without any
   reference has no ordinary score: there all pages stand out.

Defined results: pages with NULL or blank markdown give no row; a main body of headings alone has zero statistics and
class `prose`; repeated deliveries count once; labels that name no known language form the group `und`; an empty
table gives an empty result; texts of any length are read whole. A text in words that no other text of the table has
and without short words of the five known languages cannot be told from noise and is junk.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tarnloom.llm.arrow import Hashed, cut_words, map_rows
from tarnloom.llm.labels import language_code
from tarnloom.llm.mainbody import main_body
from tarnloom.session import materialize

BITS = 18
STATS = ("mean_word_length", "symbol_ratio", "digit_ratio", "end_punct_share", "common_share", "distinct_pairs", "longest_word", "list_share", "table_share", "junk_share")
OUTLYING = 0.5  # share of the reference that may have an outlier score as high
KNOWN_SHARE, DISTINCT_SHARE = 0.45, 0.5  # below either, a block says nothing
# Short words of the five languages, of three letters or more. Text that has FORM_SHARE of them says something
# even where the table is too small to know its other words.
FORM_WORDS = frozenset(
    "the and that with for was were are this from have has had not but they which his her their who when where would there been "
    "der die das und den dem des von mit ist sind nicht ein eine einer einem einen auf für sich auch als aus wird war waren haben hat noch "
    "les des une que qui dans pour est sur pas avec par plus aux sont cette ses mais ont était "
    "los las una que con por para del como más pero sus fue son está entre cuando sin sobre "
    "che non per una del della dei delle con sono nel nella gli alla come più anche dal era questo".split()
)
FORM_SHARE = 0.08
MIN_JUNK = 120  # characters; a shorter text is a message, whatever its words

HEADING = re.compile(r"\s*#{1,6}\s")
ITEM = re.compile(r"\s*(?:[-*•+–‣▪]\s|\(?\d{1,4}[.)]\s|[a-z][.)]\s)")
PIPES = re.compile(r"^\s*\|.*\|\s*$")
COLUMNS = (re.compile(r"\t"), re.compile(r";"), re.compile(r" {3,}"), re.compile(r"\s\|\s|^\||\|$"))
LETTERS = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?…](?:\s|$|[\"'”’»)*_])")
END_SIGNS = frozenset(".!?…")
CLOSING = "\"'”’»)]*_"


def ends_sentence(line: str) -> bool:
    """Whether a stripped line ends with a sentence's sign, closing signs behind it apart."""
    return line.rstrip(CLOSING)[-1:] in END_SIGNS


def table_rows(lines: list[str]) -> list[bool]:
    """Per line of one block, whether it is a row: the block's lines share a delimiter as often, or nearly."""
    if len(lines) == 1:
        return [lines[0].count("|") > 2 and bool(PIPES.match(lines[0]))]
    for sign in COLUMNS:
        counts = [len(sign.findall(x)) for x in lines]
        usual = max(set(counts), key=counts.count)
        if usual >= 1 and sum(abs(c - usual) <= max(1, usual // 4) and c > 0 for c in counts) >= 0.8 * len(lines) and len(lines) >= 3:
            if sign is COLUMNS[1] and usual < 2 and sum(any(ch.isdigit() for ch in x) for x in lines) < len(lines) // 2:
                continue
            return [c > 0 for c in counts]
    return [bool(PIPES.match(x)) for x in lines]


def blocks_of(no: list[int], lines: list[str]) -> list[list[str]]:
    out: list[list[str]] = []
    last = None
    for n, t in zip(no, lines):
        t = t.rstrip("\r\n")
        sign = t.lstrip()[:3]
        if sign == "```":
            last = n
            continue
        if sign[:1] == "#" and HEADING.match(t):
            last = None
            continue
        if last is not None and n == last + 1 and out:
            out[-1].append(t)
        else:
            out.append([t])
        last = n
    return out


def kinds_of(block: list[str]) -> list[str]:
    """Per line of a block: list, table or text."""
    if len(block) == 1:
        return ["table" if table_rows(block)[0] else "list" if ITEM.match(block[0]) else "text"]
    items = [ITEM.match(x) is not None for x in block]
    if len(block) >= 3 and sum(items) >= 0.6 * len(block):
        return ["list"] * len(block)
    rows = table_rows(block)
    if sum(rows) >= 0.6 * len(block):
        return ["table"] * len(block)
    if len(block) >= 3 and sum(map(len, block[:-1])) / (len(block) - 1) < 45 and sum(ends_sentence(x.strip()) for x in block) <= 0.25 * len(block):
        return ["list"] * len(block)
    return ["list" if i else "table" if r else "text" for i, r in zip(items, rows)]


class Measures:
    """What one page's main body sums up to; text holds the blocks that are neither list nor table, paragraphs those of running sentences."""

    __slots__ = ("chars", "list_chars", "table_chars", "text", "lines", "ends", "paragraphs")

    def __init__(self, no: list[int], lines: list[str]):
        self.list_chars = self.table_chars = self.chars = self.lines = self.ends = 0
        self.text: list[str] = []
        self.paragraphs: list[str] = []
        for block in blocks_of(no, lines):
            text = []
            for line, kind in zip(block, kinds_of(block)):
                line = line.strip()
                n = len(line)
                self.chars += n
                self.lines += 1
                self.ends += ends_sentence(line)
                if kind == "list":
                    self.list_chars += n
                elif kind == "table":
                    self.table_chars += n
                else:
                    text.append(line)
            if text:
                joined = " ".join(text)
                self.text.append(joined)
                if len(text) * 2 > len(block) and is_running(joined):
                    self.paragraphs.append(" ".join(joined.split()))


def is_running(text: str) -> bool:
    """Whether a block has a sentence's end and six words."""
    return SENTENCE.search(text) is not None and next(islice(LETTERS.finditer(text), 5, None), None) is not None


def text_key() -> Column:
    """Hash of a main body without its headings: copies of a text are one witness of its words, and one of the reference."""
    return F.xxhash64(F.filter("body", lambda x: ~x.rlike(r"^\s*#{1,6}\s")))


def distinct_texts(body: DataFrame) -> DataFrame:
    """One page of those whose main bodies agree but for their headings."""
    keys = body.select("page_id", text_key().alias("h"))
    kept = keys.groupBy("h").agg(F.min("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").select("h", "kept")
    return body.join(keys.join(kept, "h").where("page_id != kept").select("page_id"), "page_id", "left_anti")


def known_words(body: DataFrame) -> dict[str, np.ndarray]:
    """Per language label and, under '', for all: buckets of words met in sentences of enough texts; fixed size each."""

    def count(c: dict[str, list], table: Hashed) -> dict[str, list]:
        sums: dict[str, np.ndarray] = {}
        pages: dict[str, int] = {}
        for lang, no, lines in zip(c["lang"], c["body_no"], c["body"]):
            words: set[int] = set()
            for block in blocks_of(no, lines):
                text = " ".join(x.strip() for x in block)
                if ends_sentence(text):
                    found = cut_words(text.casefold())
                    once = set(found)
                    if len(found) >= 6 and len(once) > len(found) // 2:
                        words.update(map(table.__getitem__, once))
            if words:
                if lang not in sums:
                    sums[lang], pages[lang] = np.zeros(1 << BITS, np.int64), 0
                sums[lang][np.fromiter(words, np.int64, len(words))] += 1
                pages[lang] += 1
        sums[""], pages[""] = sum(sums.values(), np.zeros(1 << BITS, np.int64)), sum(pages.values())
        sums.pop("und", None)
        out: dict[str, list] = {"g": [], "f": [], "n": []}
        for group, held in sums.items():
            at = np.nonzero(held)[0]
            out["g"] += [group] * (len(at) + 1)
            out["f"] += [-1, *at.tolist()]
            out["n"] += [pages[group], *held[at].tolist()]
        return out

    texts = distinct_texts(body).select("lang", "body_no", "body")
    counts = map_rows(texts, count, "g string, f int, n bigint", setup=lambda: Hashed(BITS)).groupBy("g", "f").agg(F.sum("n").alias("n")).toPandas()
    known = {"": np.zeros(1 << BITS, bool)}
    for group, rows in counts.groupby("g"):
        least = max(2, 0.0005 * int(rows.loc[rows["f"] < 0, "n"].sum()))
        known[group] = np.zeros(1 << BITS, bool)
        known[group][rows.loc[(rows["f"] >= 0) & (rows["n"] >= least), "f"]] = True
    return {group: known[""] | own for group, own in known.items()}


class KnownLetters(dict):
    """word → its length if it is known, else 0, remembered; single digits are not known."""

    def __init__(self, known: np.ndarray, table: Hashed):
        super().__init__()
        self.known, self.table = known, table

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = len(word) if self.known[self.table[word]] and (len(word) > 1 or not word.isdigit()) else 0
        return value


def junk_measures(signs: int, digits: int, words: list[str], known: KnownLetters) -> tuple[float, float]:
    """Share of a block's signs that belong to known words, and of distinct word pairs; digits: of all its signs."""
    digits = sum([len(w) for w in words if w.isdigit()]) if digits else 0
    distinct = len(set(zip(words, words[1:]))) / (len(words) - 1) if len(words) > 8 else 1.0
    return sum(map(known.__getitem__, words)) / max(1, signs - digits if digits < 0.3 * signs else signs), distinct


def says_nothing(words: list[str], share: float, pairs: float) -> bool:
    """Whether a block only repeats, or has neither known words nor the short words of a language."""
    if pairs < DISTINCT_SHARE:
        return True
    return share < KNOWN_SHARE and sum(map(FORM_WORDS.__contains__, words)) <= FORM_SHARE * len(words)


def labelled_body(pages: DataFrame) -> DataFrame:
    """Main bodies with the language their label names (`und` for none)."""
    return materialize(main_body(pages.withColumn("lang", F.coalesce(language_code(F.col("meta_language")), F.lit("und"))), ["lang"]), "body")


def page_statistics(body: DataFrame, carry: list[str] = (), paragraphs: bool = False) -> DataFrame:
    """One row of statistics per page, not ranked yet, with its text_key. body: page_id, lang, body_no, body, and what is carried.

    With `paragraphs`, the blocks of running sentences pass along for operators that read them next.
    """
    carry = list(carry)
    known = body.sparkSession.sparkContext.broadcast(known_words(body))
    names = ("page_id", "lang", "text_key", "n_chars", "n_words", "n_lines", *STATS)

    def measure(c: dict[str, list], state: tuple[Hashed, dict[str, KnownLetters]]) -> dict[str, list]:
        table, letters_of = state
        out: dict[str, list] = {**{k: [] for k in names}, "paragraphs": [], **{k: c[k] for k in carry}}
        for page, lang, key, no, lines in zip(c["page_id"], c["lang"], c["text_key"], c["body_no"], c["body"]):
            m = Measures(no, lines)
            inside = letters_of.get(lang)
            if inside is None:
                inside = letters_of[lang] = KnownLetters(known.value.get(lang, known.value[""]), table)
            junk = weight = n_words = signs = letters = longest = digits = 0
            common = distinct = 0.0
            for block in m.text:
                words = cut_words(block.casefold())
                n_signs, n_digits = len("".join(block.split())), sum(map(block.count, "0123456789"))
                share, pairs = junk_measures(n_signs, n_digits, words, inside)
                lengths = list(map(len, words))
                n_words += len(words)
                letters += sum(lengths)
                longest = max(longest, *lengths) if words else longest
                signs += n_signs
                digits += n_digits
                common += share * len(block)
                distinct += pairs * len(block)
                weight += len(block)
                if len(block) >= 20 and says_nothing(words, share, pairs):
                    junk += len(block)
            chars, signs = max(1, m.chars), max(1, signs)
            row = (
                page, lang, key, m.chars, n_words, m.lines,
                letters / max(1, n_words), (signs - letters) / signs, digits / signs, m.ends / max(1, m.lines), common / max(1, weight), distinct / max(1, weight), float(longest),
                m.list_chars / chars, m.table_chars / chars, junk / chars,
            )
            for k, v in zip(names, row):
                out[k].append(v)
            out["paragraphs"].append(m.paragraphs if paragraphs else None)
        return out

    kinds = {f.name: f.dataType.simpleString() for f in body.schema}
    schema = "page_id bigint, lang string, text_key bigint, n_chars bigint, n_words bigint, n_lines bigint, " + ", ".join(f"{s} double" for s in STATS)
    schema += ", paragraphs array<string>" + "".join(f", `{k}` {kinds[k]}" for k in carry)
    source = body.select("page_id", "lang", text_key().alias("text_key"), "body_no", "body", *carry)
    rows = materialize(map_rows(source, measure, schema, setup=lambda: (Hashed(BITS), {})), "page-statistics")
    return rows if paragraphs else rows.drop("paragraphs")


def _running_counts(group: list[str], schema: pa.Schema):
    """For sorted rows (group..., value, n) of a partition: its number, and the counts of the group's lesser values in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, held = None, 0
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            n = batch.column(len(group) + 1).to_numpy()
            fresh = np.zeros(rows, bool)
            keys = [batch.column(i) for i in range(len(group))]
            for k in keys:
                fresh[1:] |= pc.fill_null(pc.not_equal(k[1:], k[:-1]), True).to_numpy(zero_copy_only=False)
            first = tuple(k[0].as_py() for k in keys)
            fresh[0] = True
            before = np.cumsum(n) - n
            starts = np.flatnonzero(fresh)
            below = before - np.repeat(before[starts], np.diff(np.append(starts, rows)))
            if first == last:
                below[: starts[1] if len(starts) > 1 else rows] += held
            last, held = tuple(k[-1].as_py() for k in keys), int(below[-1] + n[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(below, pa.int64()), pa.array(np.full(rows, part, np.int32))], schema=schema)

    return run


def exact_tails(values: DataFrame, group: list[str], counted: str | None = None) -> DataFrame:
    """For rows (group..., value): each distinct value's exact rank and the tail probabilities on both sides.

    With `counted`, a boolean column, only rows where it is true are counted; all values get their place among them.
    Equal values are counted before the shuffle; the counts are range-partitioned and sorted; counts run within a
    partition and are shifted by what the partitions before hold (at most partitions + groups rows, broadcast).
    """
    counts = values.groupBy(*group, "value").agg(F.sum(F.col(counted).cast("bigint") if counted else F.lit(1)).alias("n"))
    ranged = counts.repartitionByRange(*group, "value").sortWithinPartitions(*group, "value")
    wanted = StructType([*ranged.schema.fields, StructField("under", LongType()), StructField("part", IntegerType())])
    placed = materialize(ranged.mapInArrow(_running_counts(group, to_arrow_schema(wanted)), wanted), "ranged")
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(*group, "part").agg(F.sum("n").alias("held"))
    offsets = parts.select(*group, "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"), F.sum("held").over(Window.partitionBy(*group)).alias("total"))
    ranks = placed.join(F.broadcast(offsets), [*group, "part"]).withColumn("below", F.col("offset") + F.col("under"))
    share = lambda n: F.when(F.col("total") > 0, n / F.col("total"))
    return ranks.select(*group, "value", (F.col("below") + 1).alias("rank"), "below", F.col("n").alias("same"), "total", share(F.col("below") + F.col("n")).alias("left_tail"), share(F.col("total") - F.col("below")).alias("right_tail"))


def judged(stats: DataFrame) -> DataFrame:
    """Statistics with outlier_score, score_tail and text_class (prose, list, table, junk)."""
    ordinary = stats.where(" and ".join(f"{k} <= 0.5" for k in ("list_share", "table_share", "junk_share")))
    reference = ordinary.groupBy("lang", "text_key").agg(F.min("page_id").alias("page_id")).select("page_id", F.lit(True).alias("counted"))
    marked = stats.join(reference, "page_id", "left").withColumn("counted", F.coalesce("counted", F.lit(False)))
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("stat"), F.col(s).alias("value")) for s in STATS)))
    long = marked.select("page_id", "lang", "counted", each.alias("x")).select("page_id", "lang", "counted", "x.stat", "x.value")
    tails = exact_tails(long, ["lang", "stat"], "counted")
    # half a text is added on either side: no tail is zero, and a small reference proves little
    left, right = ((n + 0.5) / (F.col("total") + 1) for n in (F.col("below") + F.col("same"), F.col("total") - F.col("below")))
    tail = F.least(F.lit(1.0), 2 * F.least(left, right))
    scored = long.join(tails, ["lang", "stat", "value"]).groupBy("page_id", "lang", "counted").agg(F.round(F.sum(-F.log(tail)), 9).alias("value"))
    scored = materialize(scored, "scores")
    places = exact_tails(scored, ["lang"], "counted").select("lang", "value", ((F.col("total") - F.col("below") + 0.5) / (F.col("total") + 1)).alias("score_tail"))
    score = scored.join(places, ["lang", "value"]).select("page_id", F.col("value").alias("outlier_score"), "score_tail")
    kind = (
        F.when(F.col("score_tail") > OUTLYING, "prose")
        .when(F.col("list_share") > 0.5, "list")
        .when(F.col("table_share") > 0.5, "table")
        .when((F.col("junk_share") > 0.5) & (F.col("junk_share") * F.col("n_chars") >= MIN_JUNK), "junk")
        .otherwise("prose")
    )
    return stats.join(score, "page_id").withColumn("text_class", kind)


def page_quality(pages: DataFrame, body: DataFrame | None = None) -> DataFrame:
    """One row per page: its statistics, outlier_score, score_tail and text_class (prose, list, table, junk)."""
    return judged(page_statistics(labelled_body(pages) if body is None else body)).drop("text_key")


def found(pages: DataFrame) -> DataFrame:
    """p1_found: page_id, text_class."""
    return page_quality(pages).where("text_class != 'prose'").select("page_id", "text_class")
