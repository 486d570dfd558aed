"""Main text of web pages by templates deduced from token equivalence classes.

A page is read as tokens: tags, told apart by their path of open elements (words with digits
in class, id and role are left out, as they name one page), and texts, told apart by
the container they stand in. For every host, the occurrence vector of a token is how
often it is on each of the host's pages. Vectors are never gathered: a token's vector is
summed up by its number of pages, its total, and two sums of count x hash(page), which
add up in partial aggregates, so a host with a third of all pages is no hot
spot. Tokens of a host whose vectors are equal, or multiples, form an equivalence class.

A class is valid from ``LEAST_PAGES`` pages on. Paths nest by themselves, so a valid class of a
container and texts in it is a piece of the host's template: text that is on every page on which
the container is. A container all of whose own text is in its class is constant: it is no slot.
The slots are what is left, and their text is extracted:

* If the host's template has an article or main element that stands once on each of its
  pages and holds ``MASS`` of the host's text, the slots inside it.
* Otherwise all slots of the page, however many containers they are in.

Furniture (menus, forms, adverts, notices, asides, reader comments, scripts, styles) is left out by its
element, or by words of its class, id or role; words that sections of an article may bear
too (``UNSURE``) count inside an article only on a path that the host's template confirms, and
headings and paragraphs bear names of their own subject. Text inside an article is never taken
for constant, so nothing that repeats on other pages is dropped from it. A page without the host's
article falls back to its own article or main element, else to its slots.

Character references are decoded, white space inside a block becomes one
space, blocks without text fall away, and the rest are joined by a line feed.

The templates are one short row per host; they are broadcast only if there are
at most ``MAX_HOSTS`` of them, else joined by host.

Nulls and ties: a null html is empty and gives an empty text; a null url is a
host of its own. Equal masses go to the longer path, then the smaller one. Repeated rows stay
and are pages of their own. A page of any length is read whole. Extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import cut, text_chunks
from playtrail.plans.guards import bounded_broadcast

SUPPORT = 0.3
MASS = 0.6
MAX_HOSTS = 200_000
LEAST_PAGES = 3
LONG_PATH = 2_000  # characters; deeper paths are told apart by a hash

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|iframe|object)\b[^>]*/>"
    r"|<(script|style|noscript|template|textarea|svg|iframe|object)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
    r"|[^<]+|<",
    re.S | re.I,
)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Element kinds of HTML, and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - {"option", "legend", "summary"}
SAME_LEVEL = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
FURNITURE = frozenset("nav footer aside form button select head title dialog menu label input".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo promotion cookie cookies consent notice "
    "notices gdpr newsletter subscribe subscription signup sidebar side aside comment comments disqus replies share sharing "
    "social related recommended menu nav navbar navigation breadcrumb breadcrumbs footer header masthead toolbar popup modal "
    "overlay alert search login pagination pager skip widget".split()
)
# Of these, the words that a part of an article may bear as well.
UNSURE = frozenset(
    "search related social side sidebar notice notices header banner promotion promo alert recommended login signup skip "
    "comment menu replies share sharing navigation subscription sponsor sponsored widget".split()
)
CONTAINERS = frozenset(
    "article aside body center details dialog div dl fieldset figure footer form header html main menu nav ol section table ul".split()
)
SPLIT = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _names(attributes: str) -> str:
    """Class, id and role words of a tag, lower-case; words with digits name single pages and stay out."""
    found = [CAMEL.sub(" ", m[2] or m[3] or m[4] or "") for m in NAMED.finditer(attributes)]
    words = SPLIT.split(" ".join(found).lower())
    return " ".join([w for w in words if w and not any(c.isdigit() for c in w)])


class Page:
    """Walks the tokens of a page: open elements, furniture, blocks of text."""

    def __init__(self, html: str, confirmed: frozenset[str] = frozenset()):
        self.confirmed = confirmed  # paths with words of ``UNSURE`` that are the host's template
        self.unsure: set[str] = set()
        self.counts: dict[str, int] = defaultdict(int)  # tag tokens by path
        self.mass: dict[str, int] = defaultdict(int)  # characters under a path, furniture left out
        self.blocks: list[tuple[tuple[str, ...], str, str, bool]] = []  # (paths of open elements, text, container, in an article)
        self._walk(html)

    def _walk(self, html: str) -> None:
        tags: list[str] = []
        paths: list[str] = []
        skipped: list[bool] = []
        text: list[str] = []

        def flush() -> None:
            if text:
                words = " ".join(html_lib.unescape("".join(text)).split())
                text.clear()
                if words and not (skipped and skipped[-1]):
                    for p in set(paths):
                        self.mass[p] += len(words)
                    at = next((p for p, t in zip(reversed(paths), reversed(tags)) if t in CONTAINERS), "")
                    self.blocks.append((tuple(paths), words, at, any(t in ("article", "main") for t in tags)))

        def close(to: int) -> None:
            flush()
            del tags[to:], paths[to:], skipped[to:]

        for m in TOKEN.finditer(html):
            name = m[3] or m[6]
            if name is None:
                token = m[0]
                if token[0] != "<" or token == "<":
                    text.append(token)
                continue
            name = name.lower()
            if m[2] or m[5]:  # end tag
                if name in BLOCK or name in tags:
                    for k in range(len(tags) - 1, -1, -1):
                        if tags[k] == name:
                            if name in BLOCK:
                                close(k)
                            elif not any(t in BLOCK for t in tags[k:]):
                                del tags[k:], paths[k:], skipped[k:]
                            break
                continue
            if name == "br":
                text.append(" ")
                continue
            if name in BLOCK or name in FURNITURE:
                flush()
            if name in VOID:
                continue
            if name in CLOSES_P:
                for k in range(len(tags) - 1, -1, -1):
                    if tags[k] == "p":
                        close(k)
                        break
                    if tags[k] in BLOCK:
                        break
            if name in SAME_LEVEL:
                for k in range(len(tags) - 1, -1, -1):
                    if tags[k] == name or name in ("dt", "dd") and tags[k] in ("dt", "dd") or name in ("td", "th") and tags[k] in ("td", "th"):
                        close(k)
                        break
                    if tags[k] in SAME_LEVEL[name]:
                        break
            if name not in BLOCK and name not in FURNITURE:
                continue  # inline: no part of a path
            named = _names(m[4] or m[7] or "")
            path = (paths[-1] if paths else "") + "/" + name + ("." + named if named else "")
            if len(path) > LONG_PATH:
                path = "/…" + xxhash.xxh64_hexdigest(path) + "/" + name
            inside = any(t in ("article", "main") for t in tags)
            out = name in FURNITURE or (name == "header" and not inside)
            if not out and named and name in CONTAINERS and name not in ("html", "body", "article", "main"):
                words = WORDS.intersection(named.split())
                out = bool(words - UNSURE if inside else words)
                if words and not out:
                    self.unsure.add(path)
                    out = path in self.confirmed
            tags.append(name)
            paths.append(path)
            skipped.append(out or bool(skipped and skipped[-1]))
            self.counts[path] += 1
        flush()

    def text(self, main: str | None, constant: frozenset[str] = frozenset()) -> str:
        """The blocks of the main slot, or of all slots, joined."""
        own = [t for paths, t, _, _ in self.blocks if main in paths] if main else []
        for last in ("article", "main"):
            if not own:
                own = [t for paths, t, _, _ in self.blocks if any(p.rpartition("/")[2].split(".")[0] == last for p in paths)]
        return "\n".join(own or [t for _, t, at, inside in self.blocks if inside or at not in constant])


def _vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task's pages by host and token."""
    held: dict[tuple, list[int]] = {}
    names = ["host", "token", "text", "unsure", "pages", "total", "one", "two", "mass"]

    def flush() -> pa.RecordBatch:
        rows = [(*k, *v) for k, v in held.items()]
        held.clear()
        kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_(), *[pa.int64()] * 5]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    for b in text_chunks(batches):
        for host, html, page_id in zip(*(c.to_pylist() for c in b.columns)):
            page = Page(html or "")
            mark = xxhash.xxh64_intdigest(f"{page_id}/{html or ''}")
            one, two = mark & 0x3FFFFFFF, mark >> 34
            found = [("", None, False, 1, 0)]  # the page itself
            found += [(t, None, t in page.unsure, n, page.mass.get(t, 0)) for t, n in page.counts.items()]
            texts = Counter((at, xxhash.xxh64_intdigest(t) >> 1) for _, t, at, _ in page.blocks)
            found += [(at, t, False, n, 0) for (at, t), n in texts.items()]
            for token, text, unsure, count, mass in found:
                sums = held.setdefault((host, token, text, unsure), [0] * 5)
                for k, x in enumerate((1, count, one * count, two * count, mass)):
                    sums[k] += x
        if len(held) > 100_000:
            yield flush()
    yield flush()


def host_of(url):
    """The host of a url, lower-case; null or without one: empty."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(host, F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, constant, confirmed, classes, tokens): every host's article slot if it has one, its constant
    containers, its furniture inside articles, and the size of its template."""
    read = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"), "page_id")
    sums = read.mapInArrow(
        _vectors, "host string, token string, text long, unsure boolean, pages long, total long, one long, two long, mass long"
    )
    total = sums.groupBy("host", "token", "text").agg(
        F.max("unsure").alias("unsure"), *[F.sum(c).alias(c) for c in ("pages", "total", "mass")],
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("one", "two")],
    )
    # Texts that are on fewer pages are in no valid class.
    rare = F.col("text").isNotNull() & (F.col("pages") < LEAST_PAGES)
    total = cut(total.withColumn("rare", rare))
    whole = total.filter("token = '' and text is null").select("host", F.col("pages").alias("all_pages"))
    tags = total.filter("token <> '' and text is null").drop("text", "rare")
    # The class of a text and its container: on the same pages, as often or in the same multiple.
    texts = total.filter("text is not null").select("host", "token", "rare", *[F.col(c).alias(f"t_{c}") for c in ("pages", "total", "one", "two")])
    same = (F.col("t_pages") == F.col("pages")) & ~F.col("rare")
    for c in ("one", "two"):
        same = same & (F.col(f"t_{c}") * F.col("total") == F.col(c) * F.col("t_total"))
    judged = texts.join(tags.filter(F.col("pages") >= LEAST_PAGES), ["host", "token"]).select("host", "token", same.alias("same"))
    constant = judged.groupBy("host", "token").agg(F.min("same").alias("same")).filter("same").groupBy("host")
    constant = constant.agg(F.collect_list("token").alias("constant"))
    tokens = tags.join(whole, "host").filter(F.col("pages") >= SUPPORT * F.col("all_pages"))
    confirmed = tokens.filter((F.col("pages") >= LEAST_PAGES) & F.col("unsure")).groupBy("host").agg(F.collect_list("token").alias("confirmed"))
    most = tokens.groupBy("host").agg(F.max("mass").alias("most"))
    last = F.split_part(F.substring_index("token", "/", -1), F.lit("."), F.lit(1))
    frames = tokens.filter((F.col("pages") == F.col("total")) & last.isin("article", "main")).join(most, "host")
    fit = frames.filter(F.col("mass") >= MASS * F.col("most")).groupBy("host").agg(
        F.max(F.struct(F.size(F.split("token", "/")).alias("depth"), "mass", "token")).getField("token").alias("main")
    )
    sizes = tokens.groupBy("host", "pages", "total", "one", "two").agg(F.count("*").alias("n")).groupBy("host").agg(
        F.count("*").alias("classes"), F.sum("n").alias("tokens")
    )
    return sizes.join(fit, "host", "left").join(constant, "host", "left").join(confirmed, "host", "left").select(
        "host", "main", "constant", "confirmed", "classes", "tokens"
    )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, template_tokens) of every row of (page_id, url, html)."""
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    side, _ = bounded_broadcast(cut(templates(pages)), MAX_HOSTS)
    joined = rows.join(side, "host", "left").select("page_id", "url", "html", "main", "tokens", "constant", "confirmed")
    page_id, url = joined.schema["page_id"], joined.schema["url"]
    from pyspark.sql import types as T

    schema = T.StructType(
        [page_id, url, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
         T.StructField("template_tokens", T.LongType())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            got = []
            for html, main, constant, confirmed in zip(*(b.column(k).to_pylist() for k in (2, 3, 5, 6))):
                got.append(Page(html or "", frozenset(confirmed or ())).text(main, frozenset(constant or ())))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64()), b.column(4)],
                names=schema.names,
            )

    return joined.mapInArrow(run, schema)
