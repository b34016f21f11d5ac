"""Main text of pages by wrappers inferred for each host.

A page is a stream of tokens: the opening and closing tags of groups (GROUPS, with their first class or id) and the texts between them,
each a run of all that stands between two such tags. Equal neighbouring groups fold into one repeated group. The streams of a
host's different pages (exact copies count once) are aligned iteratively, in rounds of at most ALIGNED streams a task, until one
wrapper is left, a union-free regular expression: tokens that match stay; a run of tokens that only one side has becomes an optional
group; one that repeats its neighbour becomes a repeated group; a text that is the same on all aligned pages is a constant, all others fill a slot.

The wrapper tells where the host's main text lies: the innermost container (article or main, else the deepest group with nearly all
slot text) outside menus, headers, footers, sidebars, notices, adverts, forms and comments. Inside the container all stays but
groups that hold nothing but constants, on CONSTANT_PAGES pages or more: boxes of the template. Headings, paragraphs, lists and tables aren't groups and
stay even if every page has them. A page without its host's container uses its own wrapper, and one without any other
text there keeps its constants. Null or empty html gives empty text; rows that repeat give equal rows.
"""

from __future__ import annotations

import html as references
import json
import re
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules of this many hosts go to all tasks (under 300 bytes each), with this many constants in all (8 bytes each); of more, they are joined.
BROADCAST_HOSTS = 50_000
BROADCAST_CONSTANTS = 2_000_000
#: Different pages a constant stands on, at least, and streams that a task aligns to one.
CONSTANT_PAGES, ALIGNED = 3, 256
#: Element names of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data dfn del em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select".split())
APART = frozenset("nav header footer aside form dialog menu head button".split())
CLOSES = {"p": frozenset(("p",)), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")), "tr": frozenset(("tr", "td", "th", "p")),
          "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")), "option": frozenset(("option",))}
OPENS_BLOCK = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol pre section table ul".split())
SCOPES = frozenset("html body article main section div td th table ul ol dl nav aside header footer form blockquote".split())
NAMED = re.compile(r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|menu|nav|navbar|navigation|sidebar|masthead|site-header|site-footer|comments?|respond|replies|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|breadcrumbs?|pagination|pager|widget)(?:$|[\s_-])")
#: Elements that are groups of a wrapper; all others are text.
GROUPS = frozenset("html body main article section div center fieldset details".split())
BEGIN = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][A-Za-z0-9:-]*))")
STOP = re.compile("[>\"']")
NAME = re.compile(r"(?i)\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
SPACE = re.compile(r"\s+")


def _apart(tag: str, attributes: str) -> bool:
    if tag in APART:
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    return any(NAMED.search(a or b or c) for _, a, b, c in NAME.findall(attributes))


def _label(tag: str, attributes: str) -> str:
    """A tag with its first class or id: what makes two containers the same kind."""
    for name, a, b, c in NAME.findall(attributes):
        if name.lower() in ("class", "id") and (value := (a or b or c).split()):
            return f"{tag}.{value[0]}"
    return tag


def _tag_end(page: str, at: int, quotes: dict[str, int]) -> int:
    """Where a tag ends: behind the next > outside quotes. A quote that is never closed counts as a character, so
    that no place of the page is read twice."""
    while m := STOP.search(page, at):
        at = m.end()
        if m[0] == ">":
            return at
        if at <= quotes[m[0]]:
            at = page.find(m[0], at) + 1
    return len(page)


def tokens(page: str):
    """(kind, label, apart, text): kind is "open", "close" or "text"; inline tags vanish, and tags that close by rule are closed."""
    stack: list[tuple[str, str]] = []
    text: list[str] = []

    def flushed():
        if text:
            joined = SPACE.sub(" ", references.unescape("".join(text))).strip()
            text.clear()
            if joined:
                yield "text", "#", False, joined

    def closed(until: int):
        while len(stack) > until:
            yield "close", stack.pop()[1], False, ""

    at, end = 0, len(page)
    quotes = {q: page.rfind(q) for q in "\"'"}
    while at < end:
        m = BEGIN.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at:m.start()])
        if m[1] or m[2]:
            close = page.find("-->" if m[1] else ">", m.end())
            at = end if close < 0 else close + (3 if m[1] else 1)
            continue
        at = _tag_end(page, m.end(), quotes)
        attributes = page[m.end():at]
        tag = m[4].lower()
        if m[3]:
            if tag in INLINE or tag in VOID:
                continue
            place = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if place is not None:
                yield from flushed()
                yield from closed(place)
            continue
        if tag in RAW:
            if not attributes.endswith("/>"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else end
            if tag != "svg":
                yield from flushed()
            continue
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            continue
        yield from flushed()
        ends = CLOSES.get(tag) or (frozenset(("p",)) if tag in OPENS_BLOCK else frozenset())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ends:
                yield from closed(k)
                break
            if stack[k][0] in SCOPES:
                break
        if tag not in VOID:
            label = _label(tag, attributes)
            stack.append((tag, label))
            yield "open", label, _apart(tag, attributes), ""
    yield from flushed()
    yield from closed(0)


def grouped(page: str):
    """(kind, path, texts, apart) of a page's groups: "open", "close", and "text" for the run of texts between two of those."""
    path: list[str] = []  # labels of all open elements; those of groups lead to a text
    held: list[str] = []
    skipped = 0

    def groups():
        return "/".join(x for x in path if x.split(".")[0] in GROUPS)

    for kind, label, apart, text in tokens(page):
        if kind == "text":
            if not skipped:
                held.append(text)
            continue
        is_group = label.split(".")[0] in GROUPS
        if (is_group or apart) and held:
            yield "text", groups(), held
            held = []
        if kind == "open":
            path.append(label)
            skipped += bool(skipped or apart)
            if is_group and not skipped:
                yield "open", groups(), []
        else:
            if skipped and held:
                held = []
            if is_group and not skipped:
                yield "close", groups(), []
            skipped -= bool(skipped)
            path.pop()
    if held:
        yield "text", groups(), held


def _key(path: str, texts: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\0".join([path, *texts]).encode("utf-8", "surrogatepass")) - (1 << 63)


#: An item of a wrapper: path, token (<, > or #), repeated, optional, characters of a text, its key (None: a slot), pages that have it.
PATH, TOKEN, REPEATED, OPTIONAL, SIZE, TEXT, PAGES = range(7)


def _merged(x: list, y: list, same_page: bool = False) -> list:
    """Two items of the same path and token as one."""
    pages = max(x[PAGES], y[PAGES]) if same_page else x[PAGES] + y[PAGES]
    return [x[PATH], x[TOKEN], x[REPEATED] or y[REPEATED] or same_page, x[OPTIONAL] or y[OPTIONAL], x[SIZE] + y[SIZE], x[TEXT] if x[TEXT] == y[TEXT] else None, pages]


def _kinds(items: list[list]) -> list[tuple]:
    return [(x[PATH], x[TOKEN]) for x in items]


def folded(page: str) -> list[list]:
    """The page's own wrapper; equal neighbouring groups are folded into a repeated one."""
    items: list[list] = []
    begins: list[int] = []
    for kind, path, own in grouped(page):
        if kind == "text":
            items.append([path, "#", False, False, sum(map(len, own)), _key(path, own), 1])
            continue
        if kind == "open":
            begins.append(len(items))
            items.append([path, "<", False, False, 0, None, 1])
            continue
        items.append([path, ">", False, False, 0, None, 1])
        start = begins.pop()
        size = len(items) - start
        before = items[start - size:start] if start >= size else []
        if before and _kinds(before) == _kinds(items[start:]):
            items[start - size:] = [_merged(x, y, True) for x, y in zip(before, items[start:], strict=True)]
    return items


def aligned(one: list[list], two: list[list]) -> list[list]:
    """The wrapper of two wrappers: common items are merged, runs that one side lacks become optional, and one that only repeats what
    stands before it makes that a repeated group."""
    kinds = _kinds(one), _kinds(two)
    if kinds[0] == kinds[1]:
        return [_merged(x, y) for x, y in zip(one, two, strict=True)]
    out: list[list] = []
    for what, a, b, c, d in SequenceMatcher(None, *kinds, autojunk=False).get_opcodes():
        if what == "equal":
            out += [_merged(x, y) for x, y in zip(one[a:b], two[c:d], strict=True)]
            continue
        for run in (one[a:b], two[c:d]):
            if run and _kinds(run) == _kinds(out[-len(run):]):
                out[-len(run):] = [_merged(x, y, True) for x, y in zip(out[-len(run):], run, strict=True)]
            else:
                out += [[*x[:OPTIONAL], True, *x[OPTIONAL + 1:]] for x in run]
    return out


#: Tags of the main text.
NAMED_MAIN = ("article", "main")


def container(wrapper: list[list]) -> str:
    """The path of the group that holds the main text: the article or main with most slot text (the shortest of equal ones),
    else the deepest group with 9 in 10 characters of all slots. Without slots, constants count."""
    slots = [x for x in wrapper if x[TOKEN] == "#" and x[TEXT] is None] or [x for x in wrapper if x[TOKEN] == "#"]
    weight: dict[str, int] = {}
    for x in slots:
        labels = x[PATH].split("/")
        for k in range(1, len(labels) + 1):
            own = "/".join(labels[:k])
            weight[own] = weight.get(own, 0) + x[SIZE]
    named = [p for p in weight if p.rsplit("/", 1)[-1].split(".")[0] in NAMED_MAIN]
    if named:
        return min(named, key=lambda p: (-weight[p], len(p), p))
    total = sum(x[SIZE] for x in slots)
    return max((p for p, w in weight.items() if 10 * w >= 9 * total), key=lambda p: (p.count("/"), p), default="")


def template(wrapper: list[list]) -> list[int]:
    """Keys of the texts of groups that hold nothing but constants: boxes of the template. A repeated text is no constant."""
    open_: list[list] = []
    out: list[int] = []
    for x in wrapper:
        if x[TOKEN] == "<":
            open_.append([True, []])
        elif x[TOKEN] == "#":
            if open_:
                fixed = x[TEXT] is not None and not x[REPEATED] and x[PAGES] >= CONSTANT_PAGES
                open_[-1][0] &= fixed
                open_[-1][1].append(x[TEXT])
        elif open_:
            constant, held = open_.pop()
            if constant:
                out += held
            elif open_:
                open_[-1][0] = False
    return out


def rule_of(wrapper: list[list]) -> tuple[str, list[int]]:
    return container(wrapper), template(wrapper)


def main_text(page: str | None, rule: str | None, constants=frozenset()) -> str:
    """All texts inside the container but the template's boxes; inside the page's own container if it hasn't the host's."""
    if not page:
        return ""
    found = _runs(page, rule) if rule is not None else None
    if found is None:
        found = _runs(page, container(folded(page))) or []
    kept = [own for path, own in found if _key(path, own) not in constants]
    return "\n".join(text for own in kept or [own for _, own in found] for text in own)


def _runs(page: str, rule: str) -> list[tuple[str, list[str]]] | None:
    """(path, texts) of the runs in the groups of this path; None if the page has none."""
    inside, seen, out = 0, rule == "", []
    for kind, path, own in grouped(page):
        if kind == "open":
            if inside or path == rule:
                inside += 1
                seen = True
        elif kind == "close":
            inside -= bool(inside)
        elif inside or rule == "":
            out.append((path, own))
    return out if seen else None


def _hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(pages["url"].cast("string"), F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(pages["page_id"].alias("page_id"), pages["url"].cast("string").alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"), host.alias("host"))


STREAMS = "host string, page long, items string"


def streams(pages: DataFrame) -> DataFrame:
    """(host, page, items): the folded token stream of each different page, by the hash of its html."""
    from dispatchlens.llm.store import written

    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                hosts, texts = (c.to_pylist() for c in batch.slice(at, 128).columns)
                numbers = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t in texts]
                yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "page": pa.array(numbers, pa.int64()),
                                                  "items": pa.array([json.dumps(folded(t), separators=(",", ":")) for t in texts], pa.string())})

    held = _hosted(pages).where("html <> ''").select("host", "html").mapInArrow(read, STREAMS)
    return written(held.dropDuplicates(["host", "page"]), "streams")


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, page, items): one wrapper for each host, aligned in rounds; `page` is the least number of those aligned."""
    from dispatchlens.llm.store import written

    def align(batches):
        now, made, first = None, [], 0

        def row():
            return pa.RecordBatch.from_pydict({"host": pa.array([now[0]], pa.string()), "page": pa.array([first], pa.int64()), "items": pa.array([json.dumps(made, separators=(",", ":"))], pa.string())})

        for batch in batches:
            for host, salt, number, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (host, salt) != now:
                    if now is not None:
                        yield row()
                    now, made, first = (host, salt), json.loads(items), number
                else:
                    made = aligned(made, json.loads(items))
        if now is not None:
            yield row()

    held = streams(pages)
    while True:
        sizes = held.groupBy(F.col("host").alias("_host")).agg(F.count("*").alias("n"))
        if not sizes.where("n > 1").limit(1).count():
            return held
        # the streams of a host are dealt to so many tasks; null hosts can't occur
        dealt = held.join(sizes, F.col("host") == F.col("_host"))
        salt = F.pmod(F.xxhash64("page"), F.ceil(F.col("n") / ALIGNED)).cast("int")
        dealt = dealt.select("host", salt.alias("salt"), "page", "items").repartition("host", "salt").sortWithinPartitions("host", "salt", "page")
        held = written(dealt.mapInArrow(align, STREAMS), "wrappers")


def rules(found: DataFrame) -> DataFrame:
    """(host, rule, constants) of each host's wrapper: the container's path and the keys of the template's boxes."""
    def judge(batches):
        for batch in batches:
            made = [rule_of(json.loads(x)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"host": batch.column(0), "rule": pa.array([r for r, _ in made], pa.string()), "constants": pa.array([c for _, c in made], pa.list_(pa.int64()))})

    return found.select("host", "items").mapInArrow(judge, "host string, rule string, constants array<bigint>")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row."""
    from dispatchlens.llm.store import written

    found = written(rules(wrappers(pages)), "rules")
    rows = _hosted(pages)
    kind = rows.schema["page_id"].dataType.simpleString()
    other = found.select(F.col("host").alias("_host"), "rule", "constants")
    sizes = found.agg(F.count("*").alias("hosts"), F.coalesce(F.sum(F.size("constants")), F.lit(0)).alias("constants")).first()
    if sizes["hosts"] <= BROADCAST_HOSTS and sizes["constants"] <= BROADCAST_CONSTANTS:
        other = F.broadcast(other)
    rows = rows.join(other, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "rule", "constants")

    def run(batches):
        for batch in batches:
            given = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            own = [main_text(h, r, frozenset(c or ())) for h, r, c in given]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.string())], ["page_id", "url", "text"])

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string")
