"""Problem 2: the main body of each page, by tag-path ratios with evidence gathered over the corpus.

1. Each page is parsed once; text length, punctuation and link text are summed per root-to-leaf tag path,
   smoothed along the page, fused and thresholded (`tagpaths`); every markdown line takes the label of the text
   node in which it stands.
2. The same words come back in navigation, notices and prompts of all sites. Word and word-pair counts of lines
   that structure alone calls boilerplate or content are summed over all pages into a table of fixed size.
3. A line whose structure says too little (a plain paragraph beside the text, a block on a page with hardly any
   text, a page without html) is decided by the log-odds of its words.

Defined results: pages whose markdown is NULL or blank have no lines; repeated deliveries of a page_id count once
(the latest scraped_at, ties by content); NULL page_id rows are left out; html NULL or blank leaves the words and
the place before the heading to decide; texts of any length are processed whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnloom.llm.arrow import ASCII_SIGNS, Hashed, distinct, map_rows
from tarnloom.llm.tagpaths import LINK_TARGET, lines_of
from tarnloom.session import materialize

BITS, LAST = 18, (1 << 18) - 1  # buckets of the word table: 2**18 pairs of counts, whatever the corpus
PARAGRAPH = 120  # characters from which a plain paragraph of a rich page teaches what content says
SHORT = 250  # characters up to which words may turn a plain paragraph into boilerplate
CAP = 3.0  # of one feature's log-odds

WORD = re.compile(r"[^\W\d_]+|\d+")
LINE_SIGNS = ASCII_SIGNS[:10] + b"\0" + ASCII_SIGNS[11:]  # a line's end becomes a sign of its own
MIXED = -2
LINK_LINE = re.compile(r"^\s*(?:[-*•]\s*)?!?\[[^\]]*\]\([^()\s]*\)")


class LineWords(Hashed):
    """Hashed words; digits count as one word, a line's end is -1, what WORD would part further is MIXED."""

    def __missing__(self, word: str) -> int:
        if word == "\0":
            self[word] = -1
            return -1
        if not word.isdecimal() and (not word.isalnum() or any(map(str.isdecimal, word))):
            return MIXED
        if word[0] <= "9":
            word = "0"
            if "0" in self:
                return self["0"]
        return super().__missing__(word)


def line_words(text: str, table: LineWords) -> list[int]:
    if "](" in text:
        text = LINK_TARGET.sub("]", text)
    return list(map(table.__getitem__, WORD.findall(text.casefold())))


def words_of_lines(lines: list[str], table: LineWords) -> list[int]:
    """line_words of several lines in one pass, -1 after each."""
    text = "\n".join(lines)
    if "](" in text:
        text = LINK_TARGET.sub("]", text)
    signs = text.casefold().encode("utf-8", "surrogatepass").translate(LINE_SIGNS).replace(b"\0", b" \0 ")
    words = signs.decode("utf-8", "surrogatepass").split()
    out = list(map(table.__getitem__, words))
    if MIXED in out:
        out = [x for w, k in zip(words, out) for x in ((k,) if k != MIXED else map(table.__getitem__, WORD.findall(w)))]
    out.append(-1)
    return out


def pair(a, b):
    """Bucket of a word pair (is_boilerplate has it in line)."""
    return (a * 40503 + b * 7919 + 12345) & LAST


def parsed_lines(pages: DataFrame, carry: list[str] = ()) -> DataFrame:
    """One row per page: page_id, rich, and parallel arrays no, code (content+1, shape) and text; carried columns pass through."""
    carry = list(carry)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    source = pages.where(F.col("page_id").isNotNull() & (F.length(F.trim(F.col("markdown"))) > 0)).select("page_id", "scraped_at", *carry, "html", "markdown")

    def parse(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"page_id": c["page_id"], "scraped_at": c["scraped_at"], **{k: c[k] for k in carry}, "rich": [], "no": [], "code": [], "text": []}
        for html, markdown in zip(c["html"], c["markdown"]):
            sure, no, text, content, shape = lines_of(html, markdown)
            out["rich"].append(bool(no and sure))
            out["no"].append(no)
            out["code"].append([(c + 1) * 4 + s for c, s in zip(content, shape)])
            out["text"].append(text)
        return out

    schema = ", ".join(["page_id bigint", f"scraped_at {kinds['scraped_at']}", *(f"`{k}` {kinds[k]}" for k in carry), "rich boolean", "no array<int>", "code array<int>", "text array<string>"])
    lines = map_rows(source, parse, schema)
    value = ["rich", "no", "code", "text", *carry]
    once = lines.groupBy("page_id").agg(F.max_by(F.struct(*value), F.struct(F.col("scraped_at"), F.size("no"))).alias("v"))
    return materialize(once.select("page_id", "v.*").where(F.size("no") > 0), "lines")


def word_evidence(lines: DataFrame) -> np.ndarray:
    """Capped log-odds (boilerplate against content) per bucket, summed over all pages; fixed size."""

    def count(c: dict[str, list], table: LineWords) -> dict[str, list]:
        ids: tuple[list[int], list[int]] = ([], [])  # boilerplate, content; -1 parts the lines
        for rich, codes, texts in zip(c["rich"], c["code"], c["text"]):
            chosen: tuple[list[str], list[str]] = ([], [])
            for code, text in zip(codes, texts):
                content, shape = code // 4 - 1, code % 4
                if content < 0:
                    continue
                if content == 0 and LINK_LINE.match(text):
                    continue  # titles of other pages say what content says
                if content and shape == 2 and rich and len(text) < PARAGRAPH:
                    continue
                chosen[content].append(text)
            for k in (0, 1):
                if chosen[k]:
                    ids[k].extend(words_of_lines(chosen[k], table))
        sums = np.zeros((2, 1 << BITS), np.int64)
        for k in (0, 1):
            x = np.array(ids[k], np.int64)
            line = np.cumsum(x < 0) << BITS
            a, b = x[:-1], x[1:]
            ok = np.flatnonzero((a >= 0) & (b >= 0))
            once = distinct(np.concatenate([(line | x)[x >= 0], line[ok] | pair(a[ok], b[ok])]))  # a feature counts once a line
            sums[k] += np.bincount(once & ((1 << BITS) - 1), minlength=1 << BITS)
        at = np.nonzero(sums.any(axis=0))[0]
        return {"f": at.tolist(), "b": sums[0, at].tolist(), "c": sums[1, at].tolist()}

    counts = map_rows(lines.select("rich", "code", "text"), count, "f int, b bigint, c bigint", setup=lambda: LineWords(BITS))
    rows = counts.groupBy("f").agg(F.sum("b").alias("b"), F.sum("c").alias("c")).toPandas()
    b, c = np.zeros(1 << BITS), np.zeros(1 << BITS)
    b[rows["f"]], c[rows["f"]] = rows["b"], rows["c"]
    nb, nc = max(b.max(initial=0), 1.0), max(c.max(initial=0), 1.0)  # content has more words, and the benefit of doubt
    odds = np.log((b + 0.5) / (nb + 1)) - np.log((c + 0.5) / (nc + 1))
    odds *= (b + c) / (b + c + 2.0)  # rare features say little
    return np.clip(odds, -CAP, CAP).astype(np.float32)


def is_boilerplate(text: str, code: int, rich: bool, odds: list[float], table: LineWords) -> bool:
    """The fused decision for one line (without its neighbours)."""
    content, shape = code // 4 - 1, code % 4
    if content == 1 and shape == 1 or content == 1 and len(text) > SHORT:
        return False
    if content == 0 and shape == 0 or content < 0 and shape == 3 and LINK_LINE.match(text):
        return True
    words = line_words(text, table)
    score = sum([odds[f] for f in {*words, *[(a * 40503 + b * 7919 + 12345) & LAST for a, b in zip(words, words[1:])]}])
    if content == 1:
        return score > (1.0 if rich else 4.0)
    if content == 0:
        return score > (-12.0 if rich else -4.0)
    return score > 0.0


def split_lines(rich: bool, no: list[int], code: list[int], text: list[str], odds: list[float], table: LineWords) -> list[bool]:
    """Per line, whether it is boilerplate."""
    out = [is_boilerplate(t, c, rich, odds, table) for c, t in zip(code, text)]
    if code and not any(code):  # no html: the page's place and blocks
        heading = next((i for i, t in enumerate(text) if t.startswith("# ")), 0)
        for i in range(len(text)):
            if i < heading or i == heading and text[i].startswith("# "):
                out[i] = i < heading
            elif i > heading + 1 and no[i] == no[i - 1] + 1 and out[i - 1] and (LINK_LINE.match(text[i]) or len(text[i]) < 80):
                out[i] = True
    return out


def main_body(pages: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Problem 2: per page_id the main body's lines (body_no, body) and the numbers of all other lines (other_no)."""
    carry = list(carry)
    lines = parsed_lines(pages, carry)
    odds = pages.sparkSession.sparkContext.broadcast(word_evidence(lines))
    kinds = {f.name: f.dataType.simpleString() for f in lines.schema}

    def split(c: dict[str, list], state: tuple[list[float], LineWords]) -> dict[str, list]:
        out: dict[str, list] = {"page_id": c["page_id"], **{k: c[k] for k in carry}, "body_no": [], "body": [], "other_no": []}
        for rich, no, code, text in zip(c["rich"], c["no"], c["code"], c["text"]):
            drop = split_lines(rich, no, code, text, *state)
            out["body_no"].append([n for n, d in zip(no, drop) if not d])
            out["body"].append([t for t, d in zip(text, drop) if not d])
            out["other_no"].append([n for n, d in zip(no, drop) if d])
        return out

    schema = ", ".join(["page_id bigint", *(f"`{k}` {kinds[k]}" for k in carry), "body_no array<int>", "body array<string>", "other_no array<int>"])
    return map_rows(lines, split, schema, setup=lambda: (odds.value.tolist(), LineWords(BITS)))


def boilerplate_lines(pages: DataFrame) -> DataFrame:
    """p2_found: page_id, line_no of the lines outside the main body."""
    return main_body(pages).select("page_id", F.explode("other_no").alias("line_no")).select("page_id", F.col("line_no").cast("bigint"))


def main_body_text(pages: DataFrame) -> DataFrame:
    """Each page with only its main body: page_id, main_text, n_lines_kept, n_lines_dropped."""
    return main_body(pages).select("page_id", F.array_join("body", "\n").alias("main_text"), F.size("body").cast("bigint").alias("n_lines_kept"), F.size("other_no").cast("bigint").alias("n_lines_dropped"))
