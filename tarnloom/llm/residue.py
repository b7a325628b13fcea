"""Problem 3: pages whose main body is template residue, filler, an error message or a demand to run scripts.

1. The main body is cut into units (blocks between blank lines, wrapped lines joined).
2. Words met in short units of a share of all sites are constants of a template, all others (names, numbers, codes,
   left-over variables) are slots: units of any length with the same constants in the same order are aligned records of
   one template.
3. Templates are summed over the corpus: on how many pages and sites, how often on pages with nothing else to say,
   how often a slot keeps a variable's name, a default or a blank. A long unit is residue by its template's slots alone.
4. A unit is residue if its own slots keep variables, or its template's do, or its template is a whole-page message
   that comes back over sites on pages without content, or it is filler text. Rare wordings of such messages are
   told by the words and word pairs of aligned ones and of what stands alone on a page, against all other units.
5. A page is a case if it has residue and no more than a stray sentence beside it.

Defined results: pages with NULL or blank markdown are no cases; a page whose main body is only its heading is a case
only if the heading keeps variables; repeated deliveries count once; sites may be NULL (one site); texts of any
length are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tarnloom.llm.arrow import Hashed, cut_words, distinct, map_rows
from tarnloom.llm.mainbody import main_body
from tarnloom.llm.sitelines import site_of
from tarnloom.session import materialize

BITS = 18
SHORT = 300  # characters of the units that teach what is constant and what messages say; units of any length are aligned
MAX_TEMPLATES = 1_000_000  # whole-page templates that are broadcast (8 bytes each); more are joined to their pages
SITE_SHARE = 0.005  # of all sites, from which a word is a constant
MIN_PAGES, MIN_ALONE, MIN_RESIDUE = 3, 0.7, 0.5
LIKE_MESSAGE = 3.0  # summed log-odds from which words alone make a message
ALONE = 400  # characters of main body up to which a page has hardly any text
STRAY = 200  # characters of other text that may stand beside residue

# Fixed forms in which template languages leave variables, and default values.
LEFT_OVER = re.compile(
    r"\{\{[^{}]*\}\}|\[\[[^\[\]]*\]\]|\$\{[^{}]*\}|<%[^%]*%>|\{%[^%]*%\}|%%[\w.\s-]+%%|@@[\w.\s-]+@@|##?[a-z][\w.]*[._][\w.]*#|#[A-Za-z][\w.]*#|__[A-Za-z][\w.]*__"
    r"|&lt;/?[A-Za-z][\w.\s-]*&gt;|<[A-Za-z][\w.]*>|\{[A-Za-z_]\w*(?:\.\w+)*\}|\{\d+\}|\[(?:INSERT|insert|YOUR|your|ADD|add)\b[^\]]*\]|\bX{3,}\b|\bTODO\b:?\s*[\w.]*|\[object Object\]|\bundefined\b|\bNaN\b|%[A-Z][A-Z_]+%|:[a-z]+_[a-z]+:"
)
# Fixed vocabulary of the printers' filler text and of its usual generators.
FILLER = frozenset(
    """a ac accumsan ad adipiscing aenean aliqua aliquam aliquip amet anim ante aptent arcu at auctor augue aute bibendum blandit cillum commodo
    condimentum congue consectetur consequat convallis cras culpa cupidatat curabitur cursus dapibus deserunt diam dictum dignissim dis do dolor
    dolore donec dui duis ea efficitur egestas eget eiusmod eleifend elementum elit enim erat eros esse est et etiam eu euismod ex excepteur exercitation
    facilisi facilisis fames faucibus felis fermentum feugiat finibus fringilla fugiat fusce gravida habitant hendrerit iaculis id imperdiet in
    incididunt integer interdum ipsum irure justo labore laboris laborum lacinia lacus laoreet lectus leo libero ligula lobortis lorem luctus maecenas
    magna malesuada massa mattis mauris maximus metus mi minim molestie mollis mollit morbi nam nec neque nibh nisi nisl non nostrud nulla nullam nunc
    occaecat odio officia orci ornare pariatur pellentesque pharetra phasellus placerat porta porttitor posuere praesent pretium proident pulvinar
    purus quam qui quis quisque reprehenderit rhoncus risus rutrum sagittis sapien scelerisque sed sem semper sint sit sodales sollicitudin sunt
    suscipit suspendisse tellus tempor tempus tincidunt tortor tristique turpis ullamco ullamcorper ultrices ultricies urna ut varius vehicula vel velit
    veniam venenatis vestibulum vitae vivamus viverra voluptate volutpat vulputate""".split()
)
#: Signs without one of which LEFT_OVER matches nothing; looking for them first is cheap.
SIGNS = ("{", "[[", "[INSERT", "[insert", "[YOUR", "[your", "[ADD", "[add", "[object", "<", "%", "@@", "#", "_", "&lt;", "XXX", "TODO", "undefined", "NaN")
MARKED = re.compile(r"[^\W_]+|\x01")
ITEM = re.compile(r"\s*(?:[-*•|]\s|\d+[.)]\s)")
SLOT = -1
LEFT = "\x01"


def units_of(no: list[int], lines: list[str]) -> list[tuple[str, int]]:
    """Blocks of consecutive lines, each as one string with its number of list or table lines."""
    out: list[list[str]] = []
    last = None
    for n, t in zip(no, lines):
        t = t.strip()
        if last is not None and n == last + 1 and out and not t.startswith("#") and not out[-1][-1].startswith("#"):
            out[-1].append(t)
        else:
            out.append([t])
        last = n
    return [(" ".join(x), sum(ITEM.match(t) is not None for t in x) or (len(x) if len(x) > 2 and max(map(len, x)) < 60 else 0)) for x in out]


class UnitWords(Hashed):
    """Hashed words; left-over variables and words with digits are slots."""

    def __missing__(self, word: str) -> int:
        if word == LEFT or any(c.isdigit() for c in word):
            self[word] = SLOT
            return SLOT
        return super().__missing__(word)


def has_residue(text: str) -> bool:
    return any(map(text.__contains__, SIGNS)) and LEFT_OVER.search(text) is not None


def is_filler(text: str) -> bool:
    return _is_filler(cut_words(text.casefold()))


def _is_filler(words: list[str]) -> bool:
    return len(words) >= 4 and sum(map(FILLER.__contains__, words)) >= 0.7 * len(words) and sum(len(w) > 4 and w in FILLER for w in words) >= 0.3 * len(words)


def skeletons(offsets: np.ndarray, words: np.ndarray, constant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per unit (words[offsets[i]:offsets[i + 1]]): a 64-bit hash of its constants in order with one slot for each run of
    other words between them, and the number of constants."""
    units = len(offsets) - 1
    held = constant[words]
    owner = np.repeat(np.arange(units), np.diff(offsets))
    kept = held.copy()
    kept[1:] |= ~held[1:] & (held[:-1] | (owner[1:] != owner[:-1]))
    if len(kept):
        kept[0] = True
    at = np.flatnonzero(kept)
    token = np.where(held[at], words[at] + 2, 1).astype(np.uint64)
    for m, r in ((0x9E3779B97F4A7C15, 30), (0xBF58476D1CE4E5B9, 27)):
        token *= np.uint64(m)
        token ^= token >> np.uint64(r)
    counts = np.bincount(owner[at], minlength=units)
    place = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    power = np.cumprod(np.full(int(place.max(initial=0)) + 1, 0x165667B19E3779F9, np.uint64))
    key = np.zeros(units, np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        key[full] = np.add.reduceat(token * power[place], (np.cumsum(counts) - counts)[full])
    return key.view(np.int64), np.bincount(owner[held], minlength=units)


def body_with_site(pages: DataFrame) -> DataFrame:
    return main_body(pages.withColumn("site", site_of(F.col("meta_source_url"))), ["site"])


HEADING, HAS_LEFT, RESIDUE, FILLED = 1, 2, 4, 8  # marks of a unit
UNITS = "page_id bigint, site bigint, chars array<int>, lines array<int>, marks array<int>, sizes array<int>, words binary"


def body_units(body: DataFrame) -> DataFrame:
    """One row per page: the hash of its site, and for its units in order chars, lines (of lists and tables), marks and
    sizes (number of words), with the hashed words of all in one array: its bytes as int32, which pass between
    workers and tables whole."""

    def cut(c: dict[str, list], table: UnitWords) -> dict[str, list]:
        out: dict[str, list] = {"page_id": c["page_id"], "site": c["site"], "chars": [], "lines": [], "marks": [], "sizes": [], "words": []}
        for no, lines in zip(c["body_no"], c["body"]):
            chars, n_lines, marks, sizes, ids = [], [], [], [], []
            for text, n in units_of(no, lines):
                heading = text.startswith("#")
                left = has_residue(text)
                words = cut_words(text.casefold())
                filler = not heading and _is_filler(words)
                if left:
                    words = MARKED.findall(LEFT_OVER.sub(" " + LEFT + " ", text).casefold())
                residue = left and (len(text) <= SHORT or len(LEFT_OVER.findall(text)) * 80 >= len(text))
                chars.append(len(text))
                n_lines.append(n)
                marks.append(HEADING * heading | HAS_LEFT * left | RESIDUE * residue | FILLED * filler)
                if heading:
                    words = []
                sizes.append(len(words))
                ids += map(table.__getitem__, words)
            for k, v in (("chars", chars), ("lines", n_lines), ("marks", marks), ("sizes", sizes), ("words", np.array(ids, np.int32).tobytes())):
                out[k].append(v)
        return out

    return map_rows(body.select("page_id", F.xxhash64(F.coalesce("site", F.lit(""))).alias("site"), "body_no", "body"), cut, UNITS, setup=lambda: UnitWords(BITS))


class Units:
    """The units of a batch of pages as flat arrays."""

    def __init__(self, batch: pa.RecordBatch):
        lists = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n in ("chars", "lines", "marks", "sizes")}
        flat = {n: c.flatten().to_numpy().astype(np.int64) for n, c in lists.items()}
        self.page_id, self.site = batch.column(0), batch.column(1).to_numpy()
        self.chars, self.lines, self.sizes = (flat[n] for n in ("chars", "lines", "sizes"))
        self.words = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.int32).astype(np.int64)
        self.heading, self.left, self.residue, self.filler = ((flat["marks"] & m) > 0 for m in (HEADING, HAS_LEFT, RESIDUE, FILLED))
        per = np.diff(lists["chars"].offsets.to_numpy())
        self.page = np.repeat(np.arange(batch.num_rows), per)
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        other = np.where(self.heading | self.residue | self.filler, 0, self.chars)
        self.alone = np.bincount(self.page, weights=other, minlength=batch.num_rows) <= ALONE  # pages with hardly any other text
        self.own = batch.column("own").to_pylist() if "own" in batch.schema.names else None

    def templates(self, constant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per unit the hash of its template, and whether it has one (two constants)."""
        key, n = skeletons(self.offsets, self.words, constant)
        return key, n >= 2

    def of(self, table: np.ndarray | None, constant: np.ndarray) -> np.ndarray:
        """Per unit, whether its template is one of the sorted table, or without a table of its page's own."""
        key, some = self.templates(constant)
        if table is None:
            mine = [set(x or ()) for x in self.own]
            return some & np.fromiter((k in mine[p] for p, k in zip(self.page.tolist(), key.tolist())), bool, len(key))
        if not len(table):
            return np.zeros(len(key), bool)
        return some & (table[np.minimum(np.searchsorted(table, key), len(table) - 1)] == key)


def _map_units(units: DataFrame, fn, schema: str) -> DataFrame:
    """fn makes columns of a batch's Units."""
    wanted = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(fn(Units(batch)), wanted)], schema=wanted)

    return units.mapInArrow(run, schema)


def feature_rows(sizes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit, feature) once for each word and word pair of each unit: places in the table of evidence."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    pairs = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.empty(0, np.int64)
    pair = (words[pairs] * 31 + words[pairs + 1] * 7 + 1) % (1 << BITS) + (1 << BITS)
    known = words >= 0
    rows = distinct(np.concatenate(((owner[known] << (BITS + 1)) | words[known], (owner[pairs] << (BITS + 1)) | pair)))
    return rows >> (BITS + 1), rows & ((2 << BITS) - 1)


def _chosen_words(u: Units, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return u.sizes[chosen], u.words[np.repeat(chosen, u.sizes)]


def constant_words(units: DataFrame) -> np.ndarray:
    """Which buckets hold words met in short units of enough sites; the last place answers for SLOT."""

    def pairs(u: Units) -> tuple:
        sites, code = np.unique(u.site, return_inverse=True)
        sizes, words = _chosen_words(u, (u.chars <= SHORT) & ~u.heading)
        code = np.repeat(code[u.page[(u.chars <= SHORT) & ~u.heading]], sizes)
        once = distinct((code[words >= 0] << BITS) | words[words >= 0])
        return sites[once >> BITS], once & ((1 << BITS) - 1)

    spread = _map_units(units, pairs, "s bigint, w int").distinct().groupBy("w").agg(F.count("*").alias("n"))
    n_sites = units.select("site").distinct().count()
    constant = np.zeros((1 << BITS) + 1, bool)
    constant[spread.where(F.col("n") >= max(2.0, SITE_SHARE * n_sites)).select("w").toPandas()["w"].to_numpy(dtype=np.int64)] = True  # at most 2**BITS
    return constant


MET = "page_id bigint, skeleton bigint, s bigint, alone int, kept int"


def met_templates(units: DataFrame, shared) -> DataFrame:
    """One row for each template of each page: page_id, skeleton, s (site), alone, kept (whether a slot keeps a variable)."""

    def meet(u: Units) -> tuple:
        key, some = u.templates(shared.value)
        at = np.flatnonzero(some)
        order = at[np.lexsort((~u.left[at], key[at], u.page[at]))]  # of a page's units of one template, one with variables first
        fresh = np.ones(len(order), bool)
        fresh[1:] = (u.page[order][1:] != u.page[order][:-1]) | (key[order][1:] != key[order][:-1])
        at = order[fresh]
        page = u.page[at]
        return u.page_id.take(pa.array(page)), key[at], u.site[page], u.alone[page].astype(np.int32), u.left[at].astype(np.int32)

    return _map_units(units, meet, MET)


def whole_templates(met: DataFrame) -> DataFrame:
    """skeleton of every template that is residue or a whole-page message.

    These are met on enough pages, and either come back over sites on pages that mostly say nothing else, or keep
    left-over variables on most of them.
    """
    g = met.groupBy("skeleton").agg(F.count("*").alias("n"), F.min("s").alias("s0"), F.max("s").alias("s1"), F.avg("alone").alias("alone"), F.avg("kept").alias("kept"))
    return g.where((F.col("n") >= MIN_PAGES) & ((F.col("alone") >= MIN_ALONE) & (F.col("s0") != F.col("s1")) | (F.col("kept") >= MIN_RESIDUE))).select("skeleton")


def message_evidence(units: DataFrame, shared, table) -> np.ndarray:
    """Capped log-odds per feature of messages (aligned ones, and what stands alone on its page) against other text; fixed size."""

    def count(u: Units) -> tuple:
        template = u.of(table and table.value, shared.value)
        alone = u.alone[u.page]
        chosen = (u.sizes > 0) & ~u.heading & ~u.filler & ~u.residue & ((u.chars <= SHORT) | template) & (template | ~alone | (u.lines < 2))
        unit, feature = feature_rows(*_chosen_words(u, chosen))
        message = (template | alone)[chosen][unit]
        o, m = (np.bincount(feature[x], minlength=2 << BITS) for x in (~message, message))
        at = np.flatnonzero(o + m)
        return at, o[at], m[at]

    rows = _map_units(units, count, "f int, o bigint, m bigint").groupBy("f").agg(F.sum("o").alias("o"), F.sum("m").alias("m")).toPandas()  # at most 2**(BITS+1)
    o, m = np.zeros(2 << BITS), np.zeros(2 << BITS)
    o[rows["f"]], m[rows["f"]] = rows["o"], rows["m"]
    no, nm = max(o.max(initial=0), 1.0), max(m.max(initial=0), 1.0)
    odds = np.log((m + 0.5) / (nm + 1)) - np.log((o + 0.5) / (no + 1))
    odds[(o + m) == 0] = 0.0
    return np.clip(odds, -3.0, 3.0).astype(np.float32)


def residue_pages(pages: DataFrame, body: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, n_units, n_residue, n_template, n_filler, other_chars, excluded."""
    sc = pages.sparkSession.sparkContext
    units = materialize(body_units(body_with_site(pages) if body is None else body), "units")
    shared = sc.broadcast(constant_words(units))
    met = met_templates(units, shared)
    templates = materialize(whole_templates(met), "templates")
    if templates.limit(MAX_TEMPLATES + 1).count() <= MAX_TEMPLATES:
        table = sc.broadcast(np.sort(templates.toPandas()["skeleton"].to_numpy(dtype=np.int64)))
    else:  # each page is told which of its own templates these are
        own = met.join(templates, "skeleton", "left_semi").groupBy("page_id").agg(F.collect_set("skeleton").alias("own"))
        units, table = materialize(units.join(own, "page_id", "left"), "units"), None

    odds = sc.broadcast(message_evidence(units, shared, table))

    def judge(u: Units) -> tuple:
        template = u.of(table and table.value, shared.value) & ~u.heading
        bad = u.residue | u.filler | template
        asked = ~bad & u.alone[u.page] & ~u.heading & (u.sizes > 1) & (u.lines < 2)
        unit, feature = feature_rows(*_chosen_words(u, asked))
        bad[np.flatnonzero(asked)[np.bincount(unit, weights=odds.value[feature], minlength=asked.sum()) > LIKE_MESSAGE]] = True
        n = len(u.site)
        total = lambda x: np.bincount(u.page, weights=x, minlength=n).astype(np.int64)
        other = ~bad & ~u.heading
        n_residue, other_chars, other_units = total(u.residue), total(np.where(other, u.chars, 0)), total(other)
        excluded = ((total(bad & ~u.heading) > 0) & (other_chars <= STRAY) & (other_units <= 1)) | ((n_residue > 0) & (other_units == 0))
        return u.page_id, total(np.ones(len(u.page))), n_residue, total(template & ~u.residue), total(u.filler), other_chars, excluded

    return _map_units(units, judge, "page_id bigint, n_units bigint, n_residue bigint, n_template bigint, n_filler bigint, other_chars bigint, excluded boolean")


def found(pages: DataFrame) -> DataFrame:
    """p3_found: page_id."""
    return residue_pages(pages).where("excluded").select("page_id")
