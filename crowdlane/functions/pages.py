"""Raw HTML of a listing page to event columns.

Nesting, comments, unquoted attributes and some two thousand named references are
beyond patterns alone, so pages are read in Arrow batches, one pass over each page; only the texts of
interest come back. One pattern cuts pages into tags and texts as long as their markup is beyond doubt;
a page with any other goes through Python's tolerant HTML reader. Both drive the same rules. What the texts
mean is worked out by column functions on the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crowdlane.functions import text
from crowdlane.functions.clock import col
from crowdlane.sources.listings import truncate_fields

#: fields of a detail list that become columns
FIELDS = ["dates", "time", "location", "address", "host", "price", "phone", "email"]


def _reader(names: list[str]) -> Callable[[pa.Array], pa.Array]:
    """Function from pages to structs of title, listed, vars, ``names``, ticket_url and website_url.

    All is defined in here, so that it travels to the executors by value.
    """
    import re
    from functools import lru_cache
    from html import unescape
    from html.parser import HTMLParser

    # fixed values: elements that have no content and no end tag, those whose content is no text, and those of interest
    void = set("area base br col embed hr img input link meta param source track wbr".split())
    raw, watched = {"script", "style"}, {"h1", "ul", "li", "span", "a"}

    # markup that leaves nothing to tolerate: names of ASCII letters, closed quotes, references ended by a semicolon.
    # An element that holds a text alone is one piece; any other "<" is the last group
    space, name, ref = r"[ \t\n\r\f]", r"[a-zA-Z][a-zA-Z0-9:_.-]*+", r"&(?:amp|lt|gt|quot|\#[0-9]{1,6});"
    quoted = "|".join(f"{q}[^{q}<>&]*+(?:{ref}[^{q}<>&]*+)*+{q}" for q in "\"'")
    attributes = f"(?:{space}++{name}(?:=(?:{quoted}|[a-zA-Z0-9!#$%()*+,.:;?@_~-]++(?=[ \\t\\n\\r\\f>])))?+)*+{space}*+"
    content = r"(?:[^<]++|<(?![/!]))*+"
    cut = re.compile(
        rf"""<(?:(?!(?i:script|style)[^a-zA-Z0-9-])([a-zA-Z][a-zA-Z0-9-]*+)({attributes})(?:(/)>|>(?:([^<]*+)(</\1{space}*+>))?+)
        | /([a-zA-Z][a-zA-Z0-9-]*+){space}*+>
        | !--(?!-?>)[^-]*+(?:-[^-]++)*+-->
        | !(?i:doctype)[^<>]*+>
        | (?i:script){attributes}>{content}</(?i:script){space}*+>
        | (?i:style){attributes}>{content}</(?i:style){space}*+>
        )([^<]*+) | (<)""",
        re.ASCII | re.VERBOSE,
    )
    pairs = re.compile(f"""({name})(?:=(?:"([^"]*)"|'([^']*)'|([^\\s"']+)))?""")

    def of(attrs: Iterable) -> tuple[dict[str, str], list[str]]:
        own = {k: v or "" for k, v in attrs}
        return own, own.get("class", "").split()

    def cut_up(attrs: str) -> tuple[dict[str, str], list[str]]:
        return of((k.lower(), unescape(a or b or c)) for k, a, b, c in pairs.findall(attrs))

    def rules(known: Callable, decoded: Callable, out: dict) -> Generator:
        """Takes the pieces of a page as groups of ``cut``, puts what they say into ``out``; gives whether that is all.

        Open elements are a stack; each open element may gather the texts inside it.
        An end tag closes the nearest open element of its name and all inside it, and is ignored where none is
        open. What is still open at the end of the page closes there.
        """
        opened: list[str] = []
        counts: dict[str, int] = {}  # open elements of a name
        gathering: list[tuple[int, list[str]]] = []  # depth of an element, and its texts
        inside: list[tuple[int, str, list]] = []  # depth of an open item, what it waits for, and that, or nothing yet
        list_depth = 0  # of the detail list, while it is open
        title = listed = None
        done = False
        while True:
            tag, attrs, slash, text, whole, end, data, _ = yield done
            if end:
                if not end.islower():
                    end = end.lower()
                if counts.get(end):
                    while True:
                        last = opened.pop()
                        counts[last] -= 1
                        if last == end:
                            break
                    depth = len(opened)
                    while gathering and gathering[-1][0] > depth:
                        gathering.pop()
                    while inside and inside[-1][0] > depth:
                        inside.pop()
                    if list_depth > depth:
                        list_depth, inside = 0, []
            elif tag:
                if not tag.islower():
                    tag = tag.lower()
                texts, closed = None, slash or whole
                if tag in watched:
                    depth = len(opened) + 1
                    if tag == "li":
                        if list_depth and not closed:
                            own, classes = known(attrs)
                            if own.get("data-name"):
                                out["items"].append((own["data-name"], wanted := []))
                                inside.append((depth, "span", wanted))
                            if "website" in classes:
                                out["links"].append(wanted := [])
                                inside.append((depth, "a", wanted))
                    elif tag == "h1":
                        if title is None:
                            out["title"] = title = texts = []
                    elif tag == "ul":
                        if listed is None:
                            own, classes = known(attrs)
                            if "detail-info" in classes:
                                out["vars"] = listed = own.get("data-gtm-vars", "")
                                list_depth = 0 if closed else depth
                    elif inside:
                        waiting = [w for _, kind, w in inside if kind == tag and not w]
                        if waiting:
                            own, classes = known(attrs)
                            if tag == "a" or "info-list-value" in classes:
                                texts = []
                                for w in waiting:
                                    w += [own.get("href", ""), texts]
                if closed:
                    if text and (gathering or texts is not None):
                        piece = (decoded(text) if "&" in text else text).strip()
                        if texts is not None:
                            texts.append(piece)
                        for _, outer in gathering:
                            outer.append(piece)
                elif tag not in void:
                    opened.append(tag)
                    counts[tag] = counts.get(tag, 0) + 1
                    if texts is not None:
                        gathering.append((depth, texts))
            if gathering:
                if data and not (opened and opened[-1] in raw):
                    piece = (decoded(data) if "&" in data else data).strip()
                    for _, outer in gathering:
                        outer.append(piece)
            elif not list_depth:
                done = listed is not None and title is not None

    class Tolerant(HTMLParser):
        """Pieces of a page with any markup."""

        def __init__(self, html: str, take: Callable) -> None:
            super().__init__()
            self.take = take
            self.feed(html)
            self.close()

        def handle_starttag(self, tag: str, attrs: list) -> None:
            self.take((tag, attrs, "", "", "", "", "", ""))

        def handle_startendtag(self, tag: str, attrs: list) -> None:
            self.take((tag, attrs, "/", "", "", "", "", ""))

        def handle_endtag(self, tag: str) -> None:
            self.take(("", "", "", "", "", tag, "", ""))

        def handle_data(self, data: str) -> None:
            self.take(("", "", "", "", "", "", data, ""))

    def begun(known: Callable, decoded: Callable) -> tuple[dict, Callable]:
        out = {"title": None, "vars": None, "items": [], "links": []}
        reading = rules(known, decoded, out)
        next(reading)
        return out, reading.send

    def read_page(html: str, known: Callable) -> dict:
        out, take = begun(known, unescape)
        pieces = cut.findall(html) if len(html) <= 1 << 20 else map(lambda m: m.groups(""), cut.finditer(html))
        for piece in pieces:
            if piece[-1]:
                out, take = begun(of, str)
                Tolerant(html, take)
                break
            if take(piece):
                break
        return out

    def result(page: dict) -> dict:
        title, said_by = page["title"], page["vars"]
        out = {"title": None if title is None else "".join(title), "listed": said_by is not None, "vars": said_by}
        # of several items with one name, or several links of one kind, the last counts
        out |= {name: "".join(wanted[1]) for name, wanted in page["items"] if wanted}
        for href, texts in filter(None, page["links"]):
            said = "".join(texts).lower()
            # a text naming tickets is a ticket link even if it also says "website"
            if "ticket" in said:
                out["ticket_url"] = href
            elif "website" in said:
                out["website_url"] = href
        return out

    kinds = [("title", pa.string()), ("listed", pa.bool_()), ("vars", pa.string())]
    kind = pa.struct(kinds + [(n, pa.string()) for n in [*names, "ticket_url", "website_url"]])

    def storable(value: object) -> object:
        # what is no character, such as half a surrogate pair, cannot be stored
        return value if not isinstance(value, str) or value.isascii() else value.encode("utf-8", "replace").decode()

    def read(pages: pa.Array) -> pa.Array:
        known = lru_cache(1024)(cut_up)  # pages of one template share most
        rows = [{} if page is None else result(read_page(page, known)) for page in (x.as_py() for x in pages)]
        return pa.StructArray.from_arrays([pa.array([storable(r.get(f.name)) for r in rows], f.type) for f in kind], fields=list(kind))

    return read


def _columns(mark: str = " ") -> str:
    texts = "".join(f", {name}{mark}string" for name in [*FIELDS, "ticket_url", "website_url"])
    return f"title{mark}string, listed{mark}boolean, vars{mark}string{texts}"


def read_page(html: Column | str) -> Column:
    """Struct of the title, whether there is a detail list, its tracking attribute, FIELDS and links; NULL where absent.

    Texts are those of all elements inside, each run of text trimmed, joined without a separator.
    """
    return F.arrow_udf(_reader(FIELDS), f"struct<{_columns(': ')}>")(col(html))


def page_title(html: Column | str) -> Column:
    """Text of the first top heading; NULL when the page has none."""
    return read_page(html)["title"]


def page_fields(pages: DataFrame, year: int) -> DataFrame:
    """One event row per page (page_id, url, html); pages without a detail list are dropped."""
    rows, read = pages.select("page_id", "url", "html"), _reader(FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = read(batch.column(2))
            columns = [*batch.columns[:2], *found.flatten()]
            kept = pa.RecordBatch.from_arrays(columns, names=["page_id", "url", *(f.name for f in found.type)])
            yield kept.filter(found.field("listed"))

    # a table function reads each page once, however many of its fields are used and filtered by
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    fields = (
        rows.mapInArrow(run, f"{types}, {_columns()}")
        .withColumnsRenamed({"title": "event_name", **{name: f"_{name}" for name in FIELDS}})
        .withColumn("category", text.extract_category("vars"))
    )
    out = fields.select(
        "page_id",
        "event_name",
        F.coalesce("_location", F.lit("")).alias("venue_name"),
        F.coalesce("_address", F.lit("")).alias("address"),
        text.parse_dates("_dates", year).alias("_d"),
        text.parse_time_range("_time").alias("_t"),
        F.coalesce("category", F.lit("General")).alias("category"),
        F.coalesce("_host", F.lit("")).alias("sponsor"),
        text.parse_cost("_price").alias("_c"),
        text.clean_phone("_phone").alias("phone"),
        text.clean_email("_email").alias("email"),
        "ticket_url",
        "website_url",
        F.col("url").alias("source_url"),
    ).select(
        "page_id",
        "event_name",
        "venue_name",
        "address",
        F.col("_d.start_date").alias("event_start_date"),
        F.col("_d.end_date").alias("event_end_date"),
        F.col("_t.start_sec").alias("start_sec"),
        F.col("_t.end_sec").alias("end_sec"),
        F.col("_d.is_multi_day").alias("is_multi_day"),
        "category",
        "sponsor",
        "_c.*",
        "phone",
        "email",
        "ticket_url",
        "website_url",
        "source_url",
    )
    return truncate_fields(out)
