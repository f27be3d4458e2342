"""HTML extraction by consensus host paths.

1. Every page is parsed whole, in time linear in its length.  Containers get scores: a block of text
   gives its length without link text to its container, half to the next container above and a
   quarter to the one after.
2. Each page votes, by share of its score, for the generalised paths (tags with classes, digits
   replaced) of its best containers; votes are summed by host and path in Spark.
3. Pages are extracted again from the containers on their host's winning path, the one with the most
   votes that the page has and that some page likes best; beyond the first it must be one that the
   page itself voted for, so that each template of a host finds its own.  A page without any, or without text there, uses its own
   best container.  Each container is widened to the article around it: title, introduction and
   further sections beside it are taken too.
Menus, headers, footers, asides, forms, adverts, notices, comments and scripts never count.  They are
told by their tags, by roles, and by classes and ids that say nothing else (ad, cookie-notice,
sidebar-box).  A class or id that joins such a word with another (social-science, promo-text) is no
proof: such an element counts half in the votes, but its text stays unless it is mostly links.
"""

from __future__ import annotations

import re
from heapq import heappop, heappush
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages
from .urls import split_url

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S
)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main "
    "menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption option title".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of text whose container is the block around them.
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th tr figcaption summary ul ol dl table tbody".split())
#: What an opening tag ends implicitly, and where the search for it stops.
ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "option": {"option"}}
CELLS = ("td", "th")
STOPS = frozenset("html body article section div main table ul ol dl aside nav footer header form blockquote td th".split())
DROPPED = frozenset(
    "head title script style noscript template iframe svg canvas object nav footer aside form button select textarea dialog menu xmp noembed noframes".split()
)
KEPT = frozenset(("html", "body", "main", "article"))
ROLES = frozenset("navigation banner contentinfo search complementary menu menubar dialog alert form".split())
HINTS = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|comments?|commentlist|disqus|repl(?:y|ies)|cookies?|consent|notices?|alert|gdpr|menu|nav\w*|breadcrumbs?|share|sharing|"
    r"social|related|recommend\w*|newsletter|subscribe|popup|modal|overlay|footer|header|masthead|topbar|widget|pag(?:er|ination)|toolbar|login|signup|search|form)"
)
HINT = re.compile(rf"(?:^|[-_]){HINTS}(?:[-_]|\d|$)", re.I)
#: Words of layout that say nothing about what an element holds.
LAYOUT = "(?:area|bar|bottom|box|button|container|global|group|icon|inner|item|left|links?|list|main|outer|page|panel|right|slot|site|top|unit|user|wrap|wrapper|zone|blog|block|posts?|articles?|story|stories|all)s?"
#: Tokens of hint words alone, of those and words of layout, and those of readers' comments, which may outweigh the article.
SURE = re.compile(rf"{HINTS}\d*(?:[-_]+(?:{HINTS}\d*|\d+))*", re.I)
LIKE = re.compile(rf"(?:{HINTS}|{LAYOUT})\d*(?:[-_]+(?:{HINTS}\d*|{LAYOUT}\d*|\d+))*", re.I)
READERS = re.compile(r"(?:comment|disqus|repl(?:y|ies)(?:[-_\d]|$))", re.I)
#: Tokens that hold a hint word and are none.
SPARED = re.compile(r"(?:has|with|no)-|(?:post|entry|article|story)[-_]header$", re.I)
TITLES = re.compile(r"(?:.*[-_])?(?:header|masthead)(?:[-_\d].*)?", re.I)
UNSURE, LIKELY, CERTAIN, COMMENTS = 1, 2, 3, 4
#: Winning paths of a host that its pages may use.
PATHS = 8


def _drops(tag: str, attrs: str) -> tuple[bool, int, bool, str]:
    """(is boilerplate, how surely its classes and id hint at it, whether they hint at a header only, generalised name)."""
    name, drop, hint, header = tag, tag in DROPPED, 0, True
    if attrs and not attrs.isspace():
        for m in ATTRIBUTE.finditer(attrs):
            key = m[1].lower()
            value = m[2] or m[3] or m[4] or ""
            if key == "class":
                tokens = value.split()
                name += "".join("." + t for t in sorted({re.sub(r"\d+", "#", t.lower().replace("/", ":")) for t in tokens}))
            elif key == "id":
                tokens = value.split()
            elif key == "role":
                drop |= tag not in KEPT and value.lower() in ROLES
                continue
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                drop |= tag not in KEPT
                continue
            else:
                continue
            if tag not in KEPT:
                for t in tokens:
                    if HINT.search(t) and not SPARED.match(t):
                        hint = max(hint, COMMENTS if READERS.match(t) and LIKE.fullmatch(t) else CERTAIN if SURE.fullmatch(t) else LIKELY if LIKE.fullmatch(t) else UNSURE)
                        header &= TITLES.fullmatch(t) is not None
    return drop, hint, hint > 0 and header, name


class Page:
    """One parsed page: nodes as parallel lists, texts as (block, node, text, in a link).

    Linear in the page: open elements are found by the places of their tags in the stack, never by walking it.
    """

    def __init__(self, html: str):
        self.tag, self.name, self.parent, self.drop, self.block, self.home, self.path_id = ["#"], [""], [-1], [False], [True], [0], [0]
        self.paths: dict[tuple[int, str], int] = {}
        self.steps: list[tuple[int, str]] = [(-1, "")]
        self.hints: dict[int, tuple[int, bool]] = {}
        self.doubt: set[int] = set()
        self.pieces: list[tuple[int, int, str, bool]] = []
        stack, block, at, links = [0], 0, 0, 0
        where: dict[str, list[int]] = {}  # places in the stack of each open tag, of blocks, and of what stops a search
        blocks, stops, hard = [0], [0], [0]
        find = TOKEN.search

        def close(to: int) -> None:
            nonlocal links
            for k in reversed(stack[to:]):
                t = self.tag[k]
                where[t].pop()
                links -= t == "a"
                if self.block[k]:
                    blocks.pop()
                if t in STOPS:
                    stops.pop()
                    if t not in CELLS:
                        hard.pop()
            del stack[to:]

        while at < len(html):
            m = find(html, at)
            end = m.start() if m else len(html)
            if end > at:
                self.pieces.append((block, stack[-1], unescape(html[at:end]), links > 0))
            if not m:
                break
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag, closing = tag.lower(), m[1] or m[4]
            if tag in VOID and not closing:
                if tag == "br" or tag == "hr":
                    self.pieces.append((block, stack[-1], " ", False))
                    block += tag == "hr"
                continue
            is_block = tag in BLOCK
            if closing:
                block += is_block
                places = where.get(tag)
                if places and (is_block or places[-1] > blocks[-1]):
                    close(places[-1])
                continue
            if is_block:
                block += 1
                ends = ENDS.get(tag, ())
                while True:
                    i = max((where[t][-1] for t in ("p", *ends) if where.get(t)), default=0)
                    if not i or (hard if ends else stops)[-1] > i:
                        break
                    t = self.tag[stack[i]]
                    close(i)
                    if t != "p":
                        break
            drop, hint, header, name = _drops(tag, m[3] or m[6] or "")
            top, new = stack[-1], len(self.tag)
            if hint:
                self.hints[new] = hint, header
            self.tag.append(tag)
            self.name.append(name)
            self.parent.append(top)
            self.drop.append(drop)
            self.block.append(is_block)
            self.home.append(new if is_block and tag not in PARAGRAPH else self.home[top])
            self.path_id.append(self._step(self.path_id[top], name) if is_block else self.path_id[top])
            if tag in RAW:
                ending = re.compile(f"</{tag}", re.I).search(html, at)
                at = ending.start() if ending else len(html)
                if ending:
                    gt = html.find(">", at)
                    at = gt + 1 if gt >= 0 else len(html)
                continue
            links += tag == "a"
            where.setdefault(tag, []).append(len(stack))
            if is_block:
                blocks.append(len(stack))
            if tag in STOPS:
                stops.append(len(stack))
                if tag not in CELLS:
                    hard.append(len(stack))
            stack.append(new)
        titles = self._hinted() if self.hints else frozenset()
        self._headers(titles)

    def _step(self, above: int, name: str) -> int:
        if (got := self.paths.get((above, name))) is None:
            got = self.paths[above, name] = len(self.steps)
            self.steps.append((above, name))
        return got

    def _hinted(self) -> set[int]:
        """Drops what its classes or id hint at, but for wrappers of the article; returns the headers among it.

        A wrapper holds a main; or all articles of the page or most of its text without links: with a hint of hint
        words alone both, and with one of readers' comments neither makes it a wrapper.  An unsure hint drops what
        is mostly links and puts the rest in doubt.
        """
        n, titles = len(self.tag), set()
        for sure in (True, False):
            off = self.drop[:]
            for i in range(1, n):
                off[i] |= off[self.parent[i]]
            size, linked, articles, mains = [0] * n, [0] * n, [0] * n, [0] * n
            for _, node, text, link in self.pieces:
                if not off[node]:
                    k = len(" ".join(text.split()))
                    if link:
                        linked[node] += k
                    else:
                        size[node] += k
            for i in range(n - 1, 0, -1):
                p = self.parent[i]
                if not off[i]:
                    articles[i] += self.tag[i] == "article"
                    mains[i] += self.tag[i] == "main"
                size[p] += size[i]
                linked[p] += linked[i]
                articles[p] += articles[i]
                mains[p] += mains[i]
            for i, (hint, header) in self.hints.items():
                if off[i] or (hint != UNSURE) != sure:
                    continue
                most, every = 2 * size[i] > size[0], articles[i] > 0 and articles[i] == articles[0]
                if mains[i] or hint <= LIKELY and (most or every) or hint == CERTAIN and most and every:
                    continue
                if sure or linked[i] > size[i]:
                    self.drop[i] = True
                    if header:
                        titles.add(i)
                else:
                    self.doubt.add(i)
        return titles

    def _headers(self, titles) -> None:
        """A header element, or one hinted at, is boilerplate, but for a level-one heading in one that stands inside an article or main."""
        inside, spares = [False] * len(self.tag), [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            p = self.parent[i]
            inside[i] = inside[p] or self.tag[p] in ("article", "main")
            if self.tag[i] == "header" or i in titles:
                spares[i] = inside[i] and not self.drop[p]
                self.drop[i] = True
            elif self.drop[p]:
                spares[i] = spares[p] and not self.drop[i]
                self.drop[i] = not (spares[i] and self.tag[i] == "h1")

    def path(self, i: int) -> str:
        names, k = [], self.path_id[i]
        while k > 0:
            k, name = self.steps[k]
            names.append(name)
        return "/".join(reversed(names))

    def _number(self, path: str) -> int | None:
        k: int | None = 0
        for name in path.split("/"):
            if name and k is not None:
                k = self.paths.get((k, name))
        return k

    def scores(self) -> dict[int, float]:
        """Scores of containers; text below a doubtful hint counts half."""
        half = [False] * len(self.tag)
        if self.doubt:
            for i in range(1, len(self.tag)):
                half[i] = half[self.parent[i]] or i in self.doubt
        out: dict[int, float] = {}
        for _, node, text, link in self.pieces:
            if self.drop[node] or link:
                continue
            size = len(" ".join(text.split()))
            if size:
                i, share = self.home[node], 0.5 if half[node] else 1.0
                for _ in range(3):
                    out[i] = out.get(i, 0.0) + size * share * (1.5 if self.tag[i] in ("article", "main") else 1.0)
                    if i <= 0:
                        break
                    i, share = self.home[self.parent[i]], share / 2
        return out

    def best(self, n: int = 3) -> list[tuple[int, float]]:
        return sorted(self.scores().items(), key=lambda x: (-x[1], x[0]))[:n]

    def whole(self, roots: set[int]) -> tuple[set[int], set[int]]:
        """roots widened to the articles they are part of, and nodes of which only their own text is.

        A root in an article or main becomes that.  Above it, children beside it that are headings or mostly text
        without links join, and the parent itself if all do.  Beside other articles, and right in the body, where
        boxes of the page's layout stand, only headings and paragraphs join.  Each ancestor is looked at once,
        after all that was taken beneath it.
        """
        n = len(self.tag)
        size, linked = [0] * n, [0] * n
        for _, node, text, link in self.pieces:
            if not self.drop[node] and (k := len(" ".join(text.split()))):
                size[node] += k
                linked[node] += k * link
        children: list[list[int]] = [[] for _ in range(n)]
        within = [-1] * n  # the nearest article or main, the node itself included
        for i in range(1, n):
            within[i] = i if self.tag[i] in ("article", "main") else within[self.parent[i]]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            size[p] += size[i]
            linked[p] += linked[i]
            children[p].append(i)
        out, bare = set(), set()
        below: dict[int, tuple[set[int], bool]] = {}  # a parent: its children that were taken, and whether entirely
        heap: list[int] = []

        def up(i: int, entire: bool) -> None:
            p = self.parent[i]
            if p < 0:
                return
            if p not in below:
                heappush(heap, -p)
                below[p] = set(), True
            taken, all_entire = below[p]
            taken.add(i)
            below[p] = taken, all_entire and entire

        for i in {within[i] if within[i] > 0 else i for i in roots}:
            out.add(i)
            up(i, True)
        while heap:
            p = -heappop(heap)
            taken, entire = below[p]
            beside = [c for c in children[p] if c not in taken and size[c]]
            inner = p > 0 and self.tag[p] not in ("html", "body")
            joins = {c for c in beside if self.tag[c] in HEADINGS or 2 * linked[c] <= size[c]}
            if not inner:
                joins = {c for c in joins if self.tag[c] in PARAGRAPH}
            if any(self.tag[i] == "article" for i in taken):
                joins = {c for c in joins if self.tag[c] != "article"}
            entire = entire and inner and len(joins) == len(beside)
            out |= {p} if entire else joins
            if inner:
                bare.add(p)
            up(p, entire)
        return out, bare

    def text(self, roots: set[int], bare: set[int] = frozenset()) -> str:
        within = [False] * len(self.tag)
        for i in range(len(self.tag)):
            within[i] = i in roots or i > 0 and within[self.parent[i]]
        blocks: dict[int, list[str]] = {}
        for block, node, text, _ in self.pieces:
            if (within[node] or node in bare) and not self.drop[node]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(x).split()) for x in blocks.values())
        return "\n".join(x for x in lines if x)

    def extract(self, paths: list[str] | None) -> str:
        """The text of the first of the host's paths that the page has, beyond the first one that it voted for itself."""
        best = self.best()
        own = {self.path_id[i] for i, _ in best}
        for k, path in enumerate(paths or ()):
            at = self._number(path)
            if at is not None and (k == 0 or at in own):
                roots = {i for i in range(len(self.tag)) if self.path_id[i] == at and self.block[i] and not self.drop[i]}
                if roots and self.text(roots):
                    return self.text(*self.whole(roots))
        return self.text(*self.whole({best[0][0]})) if best else ""


def _votes(batches):
    import pyarrow as pa

    for batch in batches:
        hosts, paths, scores, firsts = [], [], [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if html:
                page = Page(html)
                best = page.best()
                total = sum(s for _, s in best)
                for k, (i, s) in enumerate(best):
                    hosts.append(host)
                    paths.append(page.path(i))
                    scores.append(round(1000 * s / total))
                    firsts.append(int(k == 0))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.int64()), pa.array(firsts, pa.int64())], ["host", "path", "score", "firsts"])


def _texts(batches):
    import pyarrow as pa

    for batch in batches:
        texts = [Page(html).extract(paths) if html else "" for html, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, one row for each row of pages (page_id, url, html; other columns are ignored).

    Null or empty html, or a page without main text: an empty text.  Null url: the host is empty and
    votes like any other.  Repeated rows vote and are extracted each.  Equal votes: the first path in
    code-point order.  Empty table: no rows.  Broken markup is read as far as it goes; an unfinished
    tag at the end is dropped.
    """
    stages = Stages(pages.sparkSession, "html")
    p = split_url(pages.select("page_id", "url", "html")).select("page_id", "url", "html", "host")
    votes = p.select("host", "html").mapInArrow(_votes, "host string, path string, score long, firsts long")
    votes = votes.groupBy("host", "path").agg(F.sum("score").alias("score"), F.sum("firsts").alias("firsts")).where("firsts > 0")  # a wrapper of many containers is none
    # the group limit of the ranks keeps at most PATHS rows of a host in each task before the shuffle
    votes = votes.withColumn("place", F.expr("row_number() over (partition by host order by score desc, path)")).where(F.col("place") <= PATHS)
    winners = votes.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "path"))), lambda x: x["path"]).alias("paths"))
    winners = stages.put(winners, "winners")  # a row for each host; its true size decides how it is joined
    kind = pages.schema["page_id"].dataType.simpleString()
    return p.join(winners, "host", "left").select("page_id", "url", "html", "paths").mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars long")


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
