"""URL algebra as Column expressions: no Python per row, so keys push down and plans stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
QUERY = r"^[^?#]*(\?[^#]*)"
FRAGMENT = r"^[^#]*(#.*)$"

# File extensions that are no pages, and marks of social and mail links.
FILE_EXTENSIONS = (
    ".png", ".jpg", ".jpeg", ".gif", ".css", ".js", ".ico", ".svg", ".tiff", ".zip", ".exe", ".dmg",
    ".mp4", ".mp3", ".wav", ".pptx", ".xlsx", ".avi", ".flv", ".woff", ".ttf", ".woff2", ".webp", ".inc",
)
SOCIAL_MARKS = ("facebook.com", "twitter.com", "linkedin.com", "instagram.com", "pinterest.com", "github.com", "calendly.com", "discord.gg", "discord.com")
NON_WEB = ("mailto:", "tel:", "telnet:", "ftp:", "ftps:", "ssh:", "file:")
#: Suffixes of two labels, under which a registrable domain has three: one of these names under a country's two letters.
#: A rule in place of the public list, which is not at hand.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gen", "gob", "gouv", "gov", "govt", "go", "ltd", "mil", "ne", "net", "nhs", "nom", "or", "org", "plc", "police", "sch")
TWO_LABEL_SUFFIX = rf"^(?:{'|'.join(SECOND_LEVEL)})\.[a-z][a-z]$"


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, SCHEME, 1))


def authority(u: Column) -> Column:
    return F.regexp_extract(u, AUTHORITY, 1)


def host(u: Column) -> Column:
    """Lower-case host without user and port."""
    return F.regexp_replace(F.lower(F.regexp_replace(authority(u), r"^[^@]*@", "")), r":\d*$", "")


def path(u: Column) -> Column:
    return F.regexp_extract(u, PATH, 1)


def query(u: Column) -> Column:
    return F.regexp_extract(u, QUERY, 1)


def fragment(u: Column) -> Column:
    return F.regexp_extract(u, FRAGMENT, 1)


def record_key(u: Column) -> Column:
    """Key of a record: lower scheme (https by default) and host, path without one trailing slash; no query, no fragment."""
    t = F.trim(u)
    p = F.regexp_replace(path(t), r";[^/]*$", "")
    cut = F.when(p == "/", p).otherwise(F.regexp_replace(p, r"/$", ""))
    sch = F.when(scheme(t) == "", F.lit("https")).otherwise(scheme(t))
    return F.when(t == "", F.lit("")).otherwise(F.concat(sch, F.lit("://"), F.lower(authority(t)), cut))


def route_fragment(u: Column) -> Column:
    """The fragment where it is a route (#/… or #!/… with something after), else ''."""
    f = fragment(u)
    return F.when(f.rlike(r"^#!?/") & (F.length(f) > 2), f).otherwise("")


def index_key(u: Column) -> Column:
    """Key of the page index: https, no default port, no www., index files as '/', no trailing slash; the query stays."""
    h = F.regexp_replace(F.regexp_replace(F.lower(authority(u)), r":(?:80|443)$", ""), r"^www\.", "")
    p = F.regexp_replace(path(u), r"/index\.(?:html|php|htm|shtml|xml)$", "/")
    p = F.when(p == "", F.lit("/")).otherwise(p)
    joined = F.concat(F.lit("https://"), h, p, query(u), route_fragment(u))
    return F.when(F.concat(query(u), route_fragment(u)) == "", F.regexp_replace(joined, r"/$", "")).otherwise(joined)


def hash_key(u: Column) -> Column:
    return F.concat(F.lit("\\x"), F.sha2(u, 256))


def path_segments(u: Column) -> Column:
    return F.filter(F.split(path(u), "/"), lambda s: s != "")


def url_splits(u: Column) -> Column:
    """The site's root, each longer path prefix, and the whole key; distinct, in order."""
    key = index_key(u)
    base = F.concat(F.lit("https://"), host(key))
    parts = path_segments(key)
    prefixes = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.concat(base, F.when(i > 0, F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))).otherwise("")))
    return F.array_distinct(F.concat(prefixes, F.array(key)))


def registrable_domain(h: Column) -> Column:
    """Last two labels, or three under a suffix of two labels."""
    labels = F.split(h, r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    three = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.lit(3)), ".")
    return F.when(two.rlike(TWO_LABEL_SUFFIX), three).otherwise(two)


def domain_splits(h: Column) -> Column:
    """The registrable domain and each longer subdomain up to the host; a lone www is dropped."""
    bare = F.regexp_replace(h, r"^www\.", "")
    base = registrable_domain(bare)
    labels = F.split(bare, r"\.")
    first = F.size(F.split(base, r"\."))
    n = F.size(labels)
    return F.transform(F.sequence(first, n), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))


def crawl_key(u: Column, ignore_query: bool = False) -> Column:
    """Key of a crawl's visited set: the fragment only where it is a route, the query unless ignored."""
    head = F.regexp_replace(u, r"[?#].*$", "")
    return F.concat(head, route_fragment(u)) if ignore_query else F.concat(head, query(u), route_fragment(u))


def permutation_key(u: Column) -> Column:
    """One representative of {http, https} × {www, bare} × {index.html, index.php, slash, none}."""
    h = F.regexp_replace(F.lower(authority(u)), r"^www\.", "")
    p = F.regexp_replace(path(u), r"/(?:index\.(?:html|php))?$", "")
    return F.concat(F.lit("http://www."), h, p, F.lit("/index.html"), query(u))


def permutations(u: Column) -> Column:
    """All spellings of the class of permutation_key."""
    h = F.regexp_replace(F.lower(authority(u)), r"^www\.", "")
    p = F.regexp_replace(path(u), r"/(?:index\.(?:html|php))?$", "")
    q = query(u)
    return F.array(*(F.concat(F.lit(f"{s}://{w}"), h, p, F.lit(e), q) for s in ("https", "http") for w in ("www.", "") for e in ("/index.html", "/index.php", "/", "")))


def depth(u: Column) -> Column:
    return F.size(F.filter(F.split(path(u), "/"), lambda s: (s != "") & ~s.isin("index.php", "index.html")))


def is_file(p: Column, fold_case: bool = False) -> Column:
    """The path ends with an extension that is no page; the case counts unless folded."""
    e = F.regexp_extract(p, r"(\.[^./]*)$", 1)
    return (F.lower(e) if fold_case else e).isin(*FILE_EXTENSIONS)


def bare_host(h: Column) -> Column:
    return F.regexp_replace(h, r"^(?:www\.)+", "")


def is_internal(u: Column, base: Column) -> Column:
    return bare_host(host(u)) == bare_host(host(base))


def has_section(u: Column) -> Column:
    """Points into a page: it has a fragment, but not one with a slash and something more, which is a route."""
    f = fragment(u)
    return (f != "") & ~(F.contains(f, F.lit("/")) & (F.length(f) > 2))


def is_non_web(u: Column) -> Column:
    return F.exists(F.array(*(F.lit(x) for x in NON_WEB)), lambda x: F.startswith(u, x))


def is_social_or_mail(u: Column) -> Column:
    return F.exists(F.array(*(F.lit(x) for x in SOCIAL_MARKS)), lambda x: F.contains(u, x))


def is_external_main_page(u: Column) -> Column:
    """Nothing but a host and perhaps a slash."""
    return F.size(path_segments(u)) == 0


def is_subdomain(u: Column, base: Column) -> Column:
    return registrable_domain(host(u)) == registrable_domain(host(base))


def same_last_labels(u: Column, v: Column) -> Column:
    last = lambda x: F.slice(F.split(F.regexp_replace(host(x), r"^www\.", ""), r"\."), -2, 2)
    both = lambda x: F.when(F.size(F.split(F.regexp_replace(host(x), r"^www\.", ""), r"\.")) >= 2, last(x))
    return F.coalesce(both(u) == both(v), F.lit(False))


def checked(u: Column, drop_query: bool = False) -> Column:
    """With http:// where no scheme is given and without a last slash; NULL unless http or https with a dotted host."""
    t = F.trim(u)
    full = F.when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), t).otherwise(F.concat(F.lit("http://"), t))
    if drop_query:
        full = F.regexp_replace(full, r"\?.*$", "")
    ok = scheme(full).isin("http", "https") & host(full).rlike(r"^[^.\s]+(?:\.[^.\s]+)+$")
    return F.when(ok, F.regexp_replace(full, r"/$", ""))


def plain(u: Column) -> Column:
    """Without scheme, www. and last slash."""
    return F.regexp_replace(F.regexp_replace(u, r"^https?://(?:www\.)?", ""), r"/$", "")


def plain_host(u: Column) -> Column:
    return F.regexp_replace(host(u), r"^www\.", "")


def is_base_domain(u: Column) -> Column:
    return registrable_domain(plain_host(u)) == plain_host(u)


def export_url(u: Column) -> Column:
    """Export address of an online document, NULL for others and for published (/d/e/) ones."""
    cases = (("document", "document", "/export?format=pdf"), ("presentation", "presentation", "/export?format=pdf"), ("spreadsheets", "spreadsheets", "/export?format=pdf"))
    out = F.lit(None).cast("string")
    for kind, name, tail in cases:
        doc = F.regexp_extract(u, rf"^https://docs\.google\.com/{kind}/d/([\w-]+)", 1)
        out = F.when((doc != "") & ~u.rlike(rf"/{kind}/d/e/"), F.concat(F.lit(f"https://docs.google.com/{name}/d/"), doc, F.lit(tail))).otherwise(out)
    drive = F.regexp_extract(u, r"^https://drive\.google\.com/file/d/([\w-]+)", 1)
    return F.when(drive != "", F.concat(F.lit("https://drive.google.com/uc?export=download&id="), drive)).otherwise(out)


def repair_scheme(u: Column) -> Column:
    """http:/x → http://x."""
    return F.regexp_replace(u, r"^(https?):/([^/])", "$1://$2")


def resolve(href: Column, base: Column) -> Column:
    """Absolute address of a link: absolute, protocol-relative, root-relative and relative forms; '' for '#…', mailto kept."""
    h = F.trim(href)
    root = F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), F.lit("//"), authority(base))
    folder = F.regexp_replace(path(base), r"[^/]*$", "")
    up = F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), F.regexp_replace(h, r"^(?:\./)+", ""))
    # every dot segment of the path takes the last one before it away, however many there are
    tail = F.regexp_extract(up, r"([?#].*)$", 1)
    parts = F.slice(F.split(F.regexp_replace(up, r"[?#].*$", ""), "/"), F.lit(4), F.size(F.split(up, "/")))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: F.when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(p == ".", acc).otherwise(F.concat(acc, F.array(p))))
    dots = F.when(parts[F.size(parts) - 1].isin("..", "."), F.lit("/")).otherwise("")
    climbed = F.concat(root, F.lit("/"), F.array_join(kept, "/"), F.when(F.size(kept) > 0, dots).otherwise(""), tail)
    return (
        F.when(F.startswith(h, F.lit("#")), F.lit(""))
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), repair_scheme(h))
        .when(F.startswith(h, F.lit("//")), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), h))
        .when(F.startswith(h, F.lit("/")), F.concat(root, h))
        .when(F.startswith(h, F.lit("?")), F.concat(root, path(base), h))
        .otherwise(climbed)
    )


def same_subdomain(u: Column, v: Column) -> Column:
    """Same domain and the same labels before it, www apart."""
    before = lambda x: F.regexp_replace(plain_host(x), r"\.?[^.]+\.[^.]+$", "")
    return same_last_labels(u, v) & (before(u) == before(v))


def adjusted_depth(base: Column, most: Column) -> Column:
    """A crawl's depth limit, counted from the root instead of from its base address."""
    return depth(base) + most
