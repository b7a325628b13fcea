"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(text: Column, most: int = 64, empty: str = "task") -> Column:
    """ASCII letters and digits, all else as single hyphens; lower case; `empty` for nothing; then cut."""
    s = F.lower(F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9]+", "-"), r"^-+|-+$", ""))
    return F.substring(F.when(s == "", F.lit(empty)).otherwise(s), 1, most)


def word_slug(text: Column) -> Column:
    """Lower case; signs other than letters, digits, blanks and hyphens go; runs of blanks and hyphens become one hyphen."""
    s = F.regexp_replace(F.trim(F.lower(text)), r"[^\p{L}\p{N}_\s-]", "")
    return F.regexp_replace(s, r"[-\s]+", "-")


def normal_name(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def preview(text: Column, most: int = 240) -> Column:
    s = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(s) > most, F.concat(F.substring(s, 1, most), F.lit("... (truncated)"))).otherwise(s)


def cut(text: Column, most: int) -> Column:
    """At most `most` signs, the last three being dots where something was cut."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("bigint")


def chunks(text: Column, size: int = 1024, overlap: int = 128) -> Column:
    """Windows of `size` signs, each beginning size - overlap after the last."""
    step = size - overlap
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(0), F.length(text) - 1, F.lit(step)), lambda i: F.substring(text, i + 1, F.lit(size))))


def without_embedded_images(markdown: Column) -> Column:
    return F.regexp_replace(markdown, r"!\[([^\]]*)\]\(data:image/[^;()]+;base64,[^)]*\)", "![$1](<Base64-Image-Removed>)")


def boxed(text: Column) -> Column:
    """The first \\boxed{…} without inner braces; '' where none."""
    return F.trim(F.regexp_extract(text, r"\\boxed\{([^{}]*)\}", 1))


def without_nul(text: Column) -> Column:
    return F.regexp_replace(text, "\x00", "")


# Fixed values of the cleaning of external content, phase by phase: containers without text, phrases of user interfaces,
# image marks, links and addresses, brackets, names of networks and their buttons, leftovers, repeated signs, line breaks.
NOISY_TAGS = ("nav", "footer", "header", "aside", "menu", "sidebar", "widget", "banner", "advertisement", "ad", "promo")
UI_PHRASES = (
    r"Skip to (main )?content", r"Main menu", r"Toggle [\w\s]+subsection", r"move to sidebar hide", r"Jump to (content|navigation)", r"Sign (In|Out|Up)", r"(Log|Register) (in|out|here)", r"Subscribe( now)?",
    r"Share (this|on):?", r"Follow (us|me) on", r"Continue reading", r"Read more", r"Posted on:", r"Published( Time)?:", r"Author:", r"Category:", r"Tags?:", r"Comments?:", r"View (all|more)", r"See also",
    r"Related (articles|links|posts)", r"Explore more", r"Previous (article|page)", r"Next (article|page)", r"Back to (top|home)", r"Edit (this|links)", r"Powered by", r"Copyright ©", r"All rights reserved",
    r"Privacy (policy|statement)", r"Terms (of|and) (Use|Service|Conditions)", r"Cookie (policy|statement|settings)", r"Manage consent", r"(Accept|Reject) (all )?cookies?",
)
NETWORK_WORDS = (r"(Facebook|Twitter|X|Instagram|LinkedIn|YouTube|Pinterest|WhatsApp|Reddit)", r"(Like|Follow|Subscribe|Share|Tweet|Pin|Upvote)")


def cleaning_steps() -> list[tuple[str, str] | None]:
    """(pattern, replacement) in order; None stands for the unescaping of characters."""
    i = "(?i)"
    steps: list[tuple[str, str] | None] = [(rf"{i}<{t}[\s\S]*?</{t}>", "") for t in ("script", "style", "noscript")]
    # a container ends with the tag it began with, so each name is a step of its own
    steps += [(rf"{i}<{t}(?:[^a-z>][^>]*)?>[\s\S]*?</{t}>", "") for t in NOISY_TAGS]
    steps += [(r"<[^>]+>", ""), None, *((i + p, "") for p in UI_PHRASES)]
    steps += [(rf"{i}Image \d+:", ""), (r"!\[Image \d+:.*?\]", ""), (r"!\(.*?\)", ""), (r"\[([^\]]+)\]\([^\)]+\)", "$1"), (rf"{i}https?://\S+", ""), (rf"{i}www\.\S+", ""), (r"\[.*?\]", "")]
    steps += [(rf"{i}{p}\s*\d*", "") for p in NETWORK_WORDS]
    steps += [(r"\.mw-parser-output.*", ""), (r"\{.*?\}", ""), (r"`.*?`", ""), (r"[_*]{2,}", ""), (r"\.{2,}", "."), (r"-{3,}", ""), (r"={3,}", "")]
    return [*steps, (r"\r\n|\r", "\n"), (r"\n\s*\n\s*\n+", "\n\n"), (r"[ \t]+", " "), (r" ?\n ?", "\n"), (r"^\s+|\s+$", "")]


def clean_external(text: Column, least: int = 50) -> Column:
    """Text of a page without markup, interface, links and leftovers; the original where fewer than `least` signs would be left."""
    s = text
    for step in cleaning_steps():
        s = unescaped(s) if step is None else F.regexp_replace(s, *step)
    return F.when(F.length(s) < least, text).otherwise(s)


def fenced_json(text: Column) -> Column:
    """The JSON text of a reply: the whole where it parses, else its first fenced block, else its outer braces or brackets."""
    bare = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    whole = bare(text)
    fence = bare(F.regexp_extract(text, r"```(?:json)?\s*([\s\S]*?)```", 1))
    braces = F.regexp_extract(text, r"(\{[\s\S]*\})", 1)
    brackets = F.regexp_extract(text, r"(\[[\s\S]*\])", 1)
    valid = lambda c: F.when(F.try_parse_json(c).isNotNull() & (F.length(c) > 0), c)
    return F.coalesce(valid(whole), valid(fence), valid(braces), valid(brackets))


def without_fences(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?m)^```[\w-]*\s*$", ""))


def resolved_issues(text: Column) -> Column:
    """Sorted distinct numbers of issues that a text closes, fixes or resolves; comments of markup do not count."""
    bare = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    found = F.regexp_extract_all(bare, F.lit(r"(?i)\b(?:close|closes|closed|fix|fixes|fixed|resolve|resolves|resolved)\s+#(\d+)"), F.lit(1))
    return F.array_sort(F.array_distinct(found))


def changed_files(diff: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(diff, F.lit(r"(?m)^\+\+\+ b/(.+?)\s*$"), F.lit(1)))


def split_patch(diff: Column) -> Column:
    """struct(fix, test): the parts of a unified diff whose path names tests go to test."""
    parts = F.filter(F.split(diff, r"(?m)(?=^diff --git )"), lambda p: F.startswith(p, F.lit("diff --git ")))
    is_test = lambda p: F.regexp_extract(p, r"^diff --git a/(\S+)", 1).rlike(r"test|e2e|testing")
    return F.struct(F.array_join(F.filter(parts, lambda p: ~is_test(p)), "").alias("fix"), F.array_join(F.filter(parts, is_test), "").alias("test"))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    most = F.greatest(F.octet_length(a), F.octet_length(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / most)


#: Classes and ids of boxes of a wiki page that are no text, and headings behind which its text ends.
WIKI_BOXES = (
    ("div", "class", "navbox"), ("table", "class", "infobox"), ("table", "class", "ambox"), ("div", "class", "reflist"), ("div", "class", "printfooter"), ("div", "class", "mw-authority-control"),
    ("div", "id", "catlinks"), ("div", "class", "portal"), ("div", "class", "hatnote"), ("div", "class", "sidebar"),
)
WIKI_ENDS = ("See also", "References", "Notes", "External links", "Further reading", "参见", "参考文献", "注释", "外部链接", "相关条目")
WIKI_END_STARTS = ("Category:", "Portal:", "Index of", "vte")


def unescaped(text: Column) -> Column:
    """The named and numbered characters that text of pages mostly has."""
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def wiki_text(html: Column) -> Column:
    """Running text of a wiki page: without boxes, markup, references, coordinates and addresses, up to the first closing heading."""
    s = html
    for tag, attribute, value in WIKI_BOXES:
        s = F.regexp_replace(s, rf'(?s)<{tag}[^>]*{attribute}="[^"]*{value}[^"]*"[^>]*>.*?</{tag}>', "")
    s = F.regexp_replace(unescaped(F.regexp_replace(s, r"<[^>]+>", "")), r"\[[^\n]*?\]", "")
    end = "(?im)^(?:" + "|".join([*(rf"{x}\s*$" for x in WIKI_ENDS), *WIKI_END_STARTS]) + ")"
    s = F.element_at(F.split(s, end, 2), 1)
    for pattern, into in ((r"(?s)\.mw-parser-output.*\{.*?\}", ""), (r"\d+°\d+′[\d.]+″[NSEW].*?/\s*.*?°[NSEW]\s*[\d.]+°[NSEW]", ""), (r"https?://\S+", ""), (r"\n\s*\n", "\n\n"), (r" +", " "), (r"^\s+|\s+$", "")):
        s = F.regexp_replace(s, pattern, into)
    return s


def tool_prefix(path: Column) -> Column:
    """Name of a data file for tools: at most the first three and the last words of its stem; never a digit first; 'data' for nothing."""
    stem = F.regexp_replace(F.element_at(F.split(F.regexp_replace(path, r"^data/", ""), "/"), -1), r"(?<=.)\.[^.]*$", "")
    words = F.filter(F.split(stem, r"[^a-zA-Z0-9]+"), lambda w: w != "")
    short = F.when(F.size(words) > 4, F.concat(F.slice(words, 1, 3), F.slice(words, -1, 1))).otherwise(words)
    name = F.lower(F.array_join(short, "_"))
    return F.when(name == "", "data").when(name.rlike(r"^\d"), F.concat(F.lit("data_"), name)).otherwise(name)


def trimmed_to_budget(text: Column, tokens: int, signs_a_token: float = 3.0) -> Column:
    """The text, cut to as many signs as the tokens are worth where its own estimate exceeds them."""
    return F.when(token_estimate(text) > tokens, F.substring(text, 1, int(tokens * signs_a_token))).otherwise(text)


def code_blocks(text: Column) -> Column:
    """Contents of the fenced blocks in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"```[\w-]*[ \t]*\n([\s\S]*?)```"), F.lit(1)), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))


def source_list(results: Column) -> Column:
    """Numbered sources of results (title, url, summary); those without a title are left out, their numbers too."""
    entry = lambda r, i: F.when(F.coalesce(r["title"], F.lit("")) != "", F.concat(F.lit("Source ["), (i + 1).cast("string"), F.lit("]:\nTitle: "), r["title"], F.lit("\nURL: "), F.coalesce(r["url"], F.lit("No URL")), F.lit("\nSummary: "), F.coalesce(r["summary"], F.lit("No Summary")), F.lit("\n")))
    body = F.array_join(F.filter(F.transform(results, entry), lambda x: x.isNotNull()), "")
    return F.when(body == "", "Empty search results\n").otherwise(F.concat(F.lit("Here are the search results/documents:\n\n"), body))


def split_pages(text: Column, marker: str = r"<\|[^|]*-page-\d+-lllmstxt\|>\n?") -> Column:
    """Pages of a text that markers part; what stands before the first marker is no page."""
    parts = F.split(text, marker)
    return F.slice(parts, F.lit(2), F.size(parts))


def without_markers(text: Column, marker: str = r"<\|[^|]*-page-\d+-lllmstxt\|>\n?") -> Column:
    return F.regexp_replace(text, marker, "")


def document_text(markdown: Column, metadata: Column, most: int = 250) -> Column:
    """Markdown followed by its metadata (a map), each value cut to `most` signs."""
    lines = F.transform(F.array_sort(F.map_entries(metadata)), lambda e: F.concat(e["key"], F.lit(": "), F.substring(F.coalesce(e["value"], F.lit("undefined")), 1, most)))
    return F.concat(markdown, F.lit("\n- - - - - Page metadata - - - - -\n"), F.array_join(lines, "\n"))


def inner_json(html: Column) -> Column:
    """Text of a page's body, which for a viewer of JSON is the JSON."""
    body = F.regexp_extract(html, r"(?is)<body[^>]*>(.*?)(?:</body>|$)", 1)
    return F.regexp_replace(unescaped(F.regexp_replace(F.when(body == "", html).otherwise(body), r"<[^>]+>", "")), r"^\s+|\s+$", "")


def json_as_markdown(content_type: Column, raw: Column, markdown: Column) -> Column:
    """A fenced block for pages that are JSON, else their markdown."""
    return F.when(F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("application/json")), F.concat(F.lit("```json\n"), raw, F.lit("\n```"))).otherwise(markdown)
