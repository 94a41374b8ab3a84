"""Main text of web pages by one template for each host, deduced from all its pages.

Every token of a page (a tag or a string between tags, told apart by the path of elements it stands in) has an occurrence
vector over the host's pages, its count on each; equal pages count as one. Spark adds up a fingerprint of each vector, and tokens of one
fingerprint form an equivalence class. Classes on too few of the pages, or without a tag, are no template. Members that leave the
order of their class on any page, or whose rounds mix, are taken out of it. The class on most pages is the frame; another class nests if on all pages
all its rounds lie between the same two neighbours of the frame. Classes that do not nest are left out. Frame
and nested classes are the template, what lies between their tokens are its slots.

Pages are parsed once and written as tokens; the steps above read these alone, and only what a host's
template may hold, bounded by the tokens of its mean page over ``SUPPORT``, comes together in a row.

The slots of an article or main element are the main text. Where a page has none, it
is in the container whose slots hold most varying words over the pages with the same containers, or else
in the page's own largest. Slots that are named as menu, header, footer, sidebar, notice, advert, form, comment or code are dropped in
either case: these vary from page to page, so occurrence does not tell them. A name is judged by its head, so `legal-history` is no notice."""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.session import materialize

#: Template tokens of all hosts together that are broadcast; more of them are joined.
BROADCAST_TOKENS = 1_000_000
#: Share of a host's different pages on which a valid class occurs at least, and number of pages if it is to hold strings.
SUPPORT = 0.3
STRING_PAGES = 3
#: Inside an article a string of the template goes only with this much evidence: passages and license lines recur there too.
ARTICLE_PAGES = 10
ARTICLE_SHARE = 0.9

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
    r"""|<(?P<open>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*?)(?P<void>/?)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?(?=[\s/]|$)""", re.I)
_MARKED = re.compile(r"class|id|role|hidden|style", re.I)
_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "xmp")}
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_DROPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea input iframe object "
    "svg canvas menu dialog audio video map label fieldset".split()
)
_DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer comment comments reply replies discussion disqus cookie cookies consent gdpr "
    "notice notices alert alerts notification popup modal overlay newsletter subscribe subscription signup login form search share sharing social "
    "related recommended widget toolbar pagination pager copyright legal complementary contentinfo".split()
)
#: Words at the end of a name that say what shape a thing has, not what it is.
_SHAPES = frozenset(
    "area bar block body bottom box button center col column container content desktop frame group holder inner item items large left link links list "
    "main mobile outer panel post posts right row section slot small text top unit wrap wrapper zone".split()
)
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that the end of an element inside them does not reach beyond.
_BARRIERS = frozenset("article main body html section div nav aside footer header form table ul ol dl blockquote".split())
_ROOTS = frozenset(("article", "main"))


class Element:
    __slots__ = ("dropped", "label", "name", "parent", "path", "root")

    def __init__(self, name: str, rest: str, parent: Element | None) -> None:
        self.name, self.parent = name, parent
        self.label, self.root, self.dropped = _traits(name, rest if _MARKED.search(rest) else "")
        self.path = f"{parent.path}/{self.label}" if parent else self.label


@lru_cache(1 << 14)
def _traits(name: str, rest: str) -> tuple[str, bool, bool]:
    """Label of a start tag, whether it is a root of main text, and whether it is dropped."""
    if not rest:
        return name, name in _ROOTS, name in _DROPPED
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(rest)}
    words = set(re.split(r"[^a-z0-9]+", " ".join(found.get(x, "") for x in ("class", "id", "role"))))
    label = name + "".join(f".{x}" for x in sorted(words) if x and not x.isdigit())
    named = any(_names_dropped(x) for key in ("class", "id", "role") for x in found.get(key, "").split())
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", found.get("style", "")))
    return label, (name in _ROOTS or found.get("role") in _ROOTS) and not named, name in _DROPPED or named or hidden


def _names_dropped(name: str) -> bool:
    """Whether the head of a compound name is a dropped word: `story-comments`, `ad-top`, but not `legal-history`."""
    words = [x for x in re.split(r"[^a-z0-9]+", name) if x and not x.isdigit()]
    while len(words) > 1 and words[-1] in _SHAPES:
        words.pop()
    return bool(words) and words[-1] in _DROPPED_WORDS


class Page:
    """Start tags and texts in page order: ("open" | "close" | "text" | "break", element, text)."""

    def __init__(self, source: str) -> None:
        self.events: list[tuple[str, Element, str]] = []
        top = Element("page", "", None)
        stack, at = [top], 0
        for token in self._tokens(source):
            begin, end, opened, closed, rest, data = token
            if begin > at:
                self._text(stack[-1], source[at:begin])
            at = end
            if data is not None:
                self.events.append(("text", stack[-1], data))
            elif opened:
                closes = _CLOSES.get(opened, {"p"} if opened not in _INLINE and opened not in _VOID else set())
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name in closes:
                        del stack[k:]
                        break
                    if stack[k].name in _BARRIERS:
                        break
                one = Element(opened, rest, stack[-1])
                self.events.append(("open", one, ""))
                if opened not in _VOID:
                    stack.append(one)
            elif closed:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == closed:
                        self.events.append(("close", stack[k], ""))
                        del stack[k:]
                        break
                    if stack[k].name in _BARRIERS and closed not in _BARRIERS:
                        break
        if at < len(source):
            self._text(stack[-1], source[at:])

    @staticmethod
    def _tokens(source: str):
        at = 0
        while match := _TOKEN.search(source, at):
            at = match.end()
            opened, closed = match["open"], match["close"]
            yield match.start(), at, (opened or "").lower(), (closed or "").lower(), match["rest"] or "", match["data"]
            if opened and (name := opened.lower()) in _RAW and not match["void"]:
                end = _RAW[name].search(source, at)
                stop, at = (end.start(), end.end()) if end else (len(source), len(source))
                yield stop, at, "", name, "", None

    def _text(self, element: Element, text: str) -> None:
        self.events.append(("text", element, html.unescape(text)))


def _kept(element: Element | None, root: Element | None) -> bool:
    """No dropped element between the text and its root; what lies above an article does not count."""
    while element is not None and element is not root:
        if element.dropped:
            return False
        element = element.parent
    return True


def _token(kind: str, path: str, text: str = "") -> int:
    """64 bits for a tag or string at a path; the last bit is set for tags."""
    value = xxhash.xxh3_64_intdigest(f"{kind}{path}\0{text}")
    return (value >> 1 << 1 | (kind != "text")) - (1 << 63)


_TOP = _token("open", "page")


def _is_tag(token: int) -> bool:
    return bool(token & 1)


def _spot(element: Element, rooted: bool) -> tuple[list[int], list[int], list[int]]:
    """Where a text stands: roots that it belongs to, and on pages without a root the elements and containers above."""
    clean, above, able = [], [], []
    kept, at = True, element
    while at is not None:
        token = _token("open", at.path) if at.root or not rooted else 0
        if at.root and kept:
            clean.append(token)
        kept = kept and not at.dropped
        if not rooted:
            above.append(token)
            if at.name not in _INLINE and at.name not in ("p", "li", "br"):
                able.append(token)
        at = at.parent
    # Without a root only texts that are not in dropped elements count.
    return clean, above if kept else [], able if kept else []


def _parsed(source: str) -> dict:
    """A page as its tokens in order, and what is needed to put its text together."""
    events = Page(source).events
    roots = [element for kind, element, _ in events if kind == "open" and element.root]
    own = {_token("open", x.path) for x in roots if _kept(x.parent, None)} or {_token("open", x.path) for x in roots}
    tokens, marks, texts, spots, known, tags = [], [], [], [], {}, {}
    for kind, element, text in events:
        if kind == "text":
            if element.path not in known:
                known[element.path] = len(spots)
                spots.append(_spot(element, bool(roots)))
            strings = " ".join(text.split())
            tokens.append(_token(kind, element.path, strings) if strings else 0)
            marks.append(2 + known[element.path])
            texts.append(text)
        else:
            key = kind, element.path
            if key not in tags:
                tags[key] = _token(*key)
            tokens.append(tags[key])
            marks.append(0 if element.name in _INLINE else 1)
    return {
        "digest": xxhash.xxh3_64_intdigest(np.array(tokens, np.int64).tobytes()) - (1 << 63),
        "own": sorted(own),
        "tokens": tokens,
        "marks": marks,
        "texts": texts,
        "spots": [dict(zip(("clean", "above", "able"), x, strict=True)) for x in spots],
    }


_PARSED = (
    "page_id bigint, url string, site bigint, digest bigint, own array<bigint>, tokens array<bigint>, marks array<int>, texts array<string>, "
    "spots array<struct<clean: array<bigint>, above: array<bigint>, able: array<bigint>>>"
)
_TEXT = "page_id bigint, url string, text string, n_chars bigint"
#: Pages that are turned from Arrow into objects at a time, and about the characters of a batch that is put out.
_ROWS, _CHARS = 64, 4 << 20
#: Sites whose classes or template a task holds.
_SITES = 256


def _rows(batches, columns: list[str]):
    """Rows as dictionaries; what is the same for a site's pages is read once while the site is among the last ones."""
    shared = [x for x in columns if x in ("classes", "fixed", "solid")]
    own = [x for x in columns if x not in shared]
    known: dict[int, dict] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            for k, row in enumerate(part.select(own).to_pylist()):
                if shared:
                    if row["site"] not in known:
                        if len(known) >= _SITES:
                            known.clear()
                        known[row["site"]] = found = {x: part.column(x)[k].as_py() for x in shared}
                        found["wanted"] = frozenset(token for one in found.get("classes", ()) for token in one["members"])
                    row.update(known[row["site"]])
                yield row


def _batches(rows, kind: pa.Schema):
    """Rows as Arrow batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("tokens") or ()) * 30 + sum(map(len, row.get("texts") or ())) + len(row.get("text") or "") + 100
        if size > _CHARS:
            yield pa.RecordBatch.from_pylist(held, kind)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, kind)


def _map(frame: DataFrame, work, schema: str) -> DataFrame:
    """``work`` maps rows, as dictionaries, to rows of the schema."""
    columns, kind = frame.columns, to_arrow_schema(T.StructType.fromDDL(schema))
    return frame.mapInArrow(lambda batches: _batches(work(_rows(batches, columns)), kind), schema)


def _parse(rows):
    for row in rows:
        yield {"page_id": row["page_id"], "url": row["url"], "site": row["site"], **_parsed(row["html"])}


def _places(row: dict) -> dict[int, list[int]]:
    """Positions of the tokens of a page that are in classes."""
    found: dict[int, list[int]] = {}
    for at, token in enumerate(row["tokens"]):
        if token in row["wanted"]:
            found.setdefault(token, []).append(at)
    return found


def _first_orders(rows):
    """For each class its members in the order of their first places, on the page with the lowest digest of those seen."""
    best: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for row in rows:
        found = None
        for one in row["classes"]:
            key = row["site"], one["shape"]
            if key not in best or row["digest"] < best[key][0]:
                found = _places(row) if found is None else found
                if one["members"][0] in found:
                    best[key] = row["digest"], sorted(one["members"], key=lambda token: found[token][0])
        if len(best) > 50_000:
            yield from ({"site": s, "shape": c, "digest": d, "members": order} for (s, c), (d, order) in best.items())
            best = {}
    yield from ({"site": s, "shape": c, "digest": d, "members": order} for (s, c), (d, order) in best.items())


def _breaks(rows):
    """Members of classes that leave the order of their class on some page."""
    told = set()
    for row in rows:
        found = _places(row)
        for one in row["classes"]:
            order = one["members"]
            if order[0] not in found:
                continue
            first = before = found[order[0]]
            for token in order[1:]:
                own = found[token]
                if all(a < b for a, b in zip(before, own, strict=True)) and all(a < b for a, b in zip(own, first[1:], strict=False)):
                    before = own
                elif (row["site"], token) not in told:
                    told.add((row["site"], token))
                    yield {"site": row["site"], "token": token}
        if len(told) > 500_000:
            told.clear()


def _gaps(rows):
    """For each class the member of the site's frame that all its rounds follow, -1 if there is no such one on a page."""
    told = set()
    for row in rows:
        found = _places(row)
        frame = next(x["members"] for x in row["classes"] if x["shape"] == row["frame"])
        marks = sorted((at, k) for k, token in enumerate(frame) for at in found.get(token, ()))
        at_frame = [at for at, _ in marks]
        for one in row["classes"]:
            if one["shape"] == row["frame"] or one["members"][0] not in found:
                continue
            gaps = set()
            for begin, end in zip(found[one["members"][0]], found[one["members"][-1]], strict=True):
                k = bisect(at_frame, begin) - 1
                inside = k >= 0 and marks[k][1] < len(frame) - 1 and bisect(at_frame, end) - 1 == k
                gaps.add(marks[k][1] if inside else -1)
            gap = gaps.pop() if len(gaps) == 1 else -1
            if (key := (row["site"], one["shape"], gap)) not in told:
                told.add(key)
                yield {"site": row["site"], "shape": one["shape"], "gap": gap}
        if len(told) > 500_000:
            told.clear()


def _of_site(frame: DataFrame, sites: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with what is known of their site: a broadcast if that is small, else a join that splits large sites."""
    small = sites.agg(F.sum("size")).first()[0] or 0
    sites = sites.drop("size")
    return frame.join(F.broadcast(sites) if small <= BROADCAST_TOKENS else sites, "site", how)


def parse(pages: DataFrame) -> DataFrame:
    """Written table of pages as tokens, with their host as a 64-bit hash."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.xxhash64(host).alias("site"), F.coalesce("html", F.lit("")).alias("html")
    )
    return materialize(_map(pages, _parse, _PARSED), "parsed-pages", compression="zstd")


def templates(parsed: DataFrame) -> DataFrame:
    """Rows (site, fixed, solid, size): tokens of the site's template, and its strings that go even inside an article."""
    distinct = parsed.select("site", "digest").distinct()
    sites = distinct.groupBy("site").agg(F.count("*").alias("n"))
    # Of equal pages all counts are the same multiple, so their tokens still have equal vectors.
    seen = parsed.select("site", "digest", F.explode("tokens").alias("token")).where("token <> 0")
    seen = seen.groupBy("site", "digest", "token").agg(F.count("*").alias("n"))
    vectors = seen.groupBy("site", "token").agg(F.bit_xor(F.xxhash64("digest", "n")).alias("shape"), F.count("*").alias("pages"))
    tag = F.col("token").bitwiseAND(1) == 1
    enough = (F.col("pages") >= SUPPORT * F.col("n")) & (tag | (F.col("pages") >= STRING_PAGES))
    classes = materialize(
        vectors.join(sites, "site").where(enough).groupBy("site", "shape")
        .agg(F.first("pages").alias("pages"), F.first("n").alias("n"), F.sort_array(F.collect_list("token")).alias("members"), F.max(tag).alias("tagged"))
        .where("tagged").drop("tagged"),
        "page-classes",
    )

    def by_site(frame: DataFrame) -> DataFrame:
        one = F.struct("shape", "members")
        return frame.groupBy("site").agg(F.sort_array(F.collect_list(one)).alias("classes"), F.sum(F.size("members")).alias("size"))

    pages = parsed.select("site", "digest", "tokens")
    orders = _map(_of_site(pages, materialize(by_site(classes), "site-classes")), _first_orders, "site bigint, shape bigint, digest bigint, members array<bigint>")
    ordered = materialize(orders.groupBy("site", "shape").agg(F.min_by("members", "digest").alias("members")), "class-orders")
    broken = _map(_of_site(pages, materialize(by_site(ordered), "site-classes")), _breaks, "site bigint, token bigint")
    broken = broken.groupBy("site").agg(F.collect_set("token").alias("broken"))
    valid = (
        ordered.join(broken, "site", "left")
        .withColumn("members", F.array_except("members", F.coalesce("broken", F.array().cast("array<bigint>"))))
        .join(classes.select("site", "shape", "pages", "n"), ["site", "shape"])
        .where(F.exists("members", lambda token: token.bitwiseAND(1) == 1)).drop("broken")
    )
    valid = materialize(valid, "valid-classes")
    frames = valid.groupBy("site").agg(F.max(F.struct("pages", F.size("members").alias("m"), "shape"))["shape"].alias("frame"))
    known = materialize(by_site(valid).join(frames, "site"), "site-classes")
    gaps = _map(_of_site(pages, known), _gaps, "site bigint, shape bigint, gap int")
    nested = gaps.groupBy("site", "shape").agg(F.min("gap").alias("low"), F.max("gap").alias("high")).where("low = high and low >= 0")
    inside = nested.select("site", "shape").union(frames.select("site", F.col("frame").alias("shape")))
    solid = (F.col("pages") >= ARTICLE_PAGES) & (F.col("pages") >= ARTICLE_SHARE * F.col("n"))
    strings = F.when(solid, F.filter("members", lambda token: token.bitwiseAND(1) == 0)).otherwise(F.array().cast("array<bigint>"))
    found = valid.join(inside, ["site", "shape"]).groupBy("site").agg(
        F.flatten(F.collect_list("members")).alias("fixed"), F.flatten(F.collect_list(strings)).alias("solid")
    )
    return materialize(found.withColumn("size", F.size("fixed")), "page-templates")


def _joined(row: dict, inside) -> dict:
    """Text of a page: strings for which ``inside`` holds, a space where a block begins or ends, white space as one space."""
    out, texts = [], iter(row["texts"])
    for token, mark in zip(row["tokens"], row["marks"], strict=True):
        if mark >= 2:
            text = next(texts)
            if inside(token, row["spots"][mark - 2]):
                out.append(text)
        elif mark:
            out.append(" ")
    text = " ".join("".join(out).split())
    return {"page_id": row["page_id"], "url": row["url"], "text": text, "n_chars": len(text)}


def _article_text(rows):
    for row in rows:
        template, solid = set(row["fixed"] or ()), set(row["solid"] or ())
        # A root that the template does not confirm still counts on a page that has no other.
        use = set(row["own"]) & template or set(row["own"])
        yield _joined(row, lambda token, spot, use=use, solid=solid: not use.isdisjoint(spot["clean"]) and token not in solid)


def _volume(row: dict, left_out: set[int], opened: set[int]) -> Counter[int]:
    """Words by container, those of some strings left out."""
    found: Counter[int] = Counter()
    texts = iter(row["texts"])
    for token, mark in zip(row["tokens"], row["marks"], strict=True):
        if mark >= 2:
            text, spot = next(texts), row["spots"][mark - 2]
            if token and spot["above"]:
                found[next((x for x in spot["able"] if x in opened), _TOP)] += 0 if token in left_out else len(text.split())
    return found


def _largest(found: Counter[int]) -> int:
    return max(found, key=lambda container: (found[container], container))


def _layouts(rows):
    """Pages without a root with their containers and the varying words of each."""
    for row in rows:
        template = set(row["fixed"] or ())
        found = _volume(row, template, template)
        layout = xxhash.xxh3_64_intdigest(np.array(sorted(found), np.int64).tobytes()) - (1 << 63)
        del row["wanted"]
        yield {**row, "layout": layout, "volume": [{"container": c, "words": n} for c, n in sorted(found.items())]}


def _body_text(rows):
    for row in rows:
        template = left_out = set(row["fixed"] or ())
        body, found = row["body"], {x["container"]: x["words"] for x in row["volume"]}
        above = {x["able"][k]: x["above"] for x in row["spots"] for k in range(len(x["able"]))}

        def below(container: int, body: int = body, above: dict = above) -> bool:
            chain = above.get(container, [container])
            return body in chain[chain.index(container) :] if container in chain else container == body

        if found and not any(n for container, n in found.items() if below(container)):
            if not any(found.values()):  # all its strings are on other pages too
                left_out = set()
                found = _volume(row, left_out, template)
            body = _largest(Counter(found))
        yield _joined(row, lambda token, spot, body=body, left_out=left_out: body in spot["above"] and token not in left_out)


def main_text(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each row of ``pages`` (page_id, url, html).

    Character references are decoded, white space within a block becomes one space, and blocks are joined by one space in
    page order. Null html counts as empty and gives an empty text; pages without a host, null urls included, form a
    host of their own. A host's pages share one template, so a page's text does not depend on how rows are dealt to tasks.
    Strings belong to it from ``STRING_PAGES`` different pages on, inside an article from ``ARTICLE_PAGES``: a page alone keeps
    all strings of its article, or of its largest container. Repeated rows are extracted each and count once in the template.
    Truncated pages end where they end, and stray end tags are ignored. Further columns are ignored."""
    parsed = parse(pages)
    known = templates(parsed)
    rooted = F.size("own") > 0
    needed = ["site", "page_id", "url", "own", "tokens", "marks", "texts", "spots"]
    articles = _map(_of_site(parsed.where(rooted).select(*needed), known, "left"), _article_text, _TEXT)
    others = _of_site(parsed.where(~rooted).select(*needed, "digest"), known, "left").drop("own", "solid")
    schema = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in others.schema)
    others = materialize(_map(others, _layouts, f"{schema}, layout bigint, volume array<struct<container: bigint, words: bigint>>"), "page-layouts")
    volumes = others.select("site", "layout", "digest", F.inline("volume")).distinct()
    volumes = volumes.groupBy("site", "layout", "container").agg(F.sum("words").alias("words"))
    bodies = volumes.groupBy("site", "layout").agg(F.max(F.struct("words", "container"))["container"].alias("body"))
    bodies = others.join(materialize(bodies, "page-bodies"), ["site", "layout"], "left")
    return articles.union(_map(bodies, _body_text, _TEXT))
