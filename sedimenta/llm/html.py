"""Main text of web pages by consensus of a host's pages on where their text stands.

Each page scores its containers and votes for the path of the best one; a path is the tags and classes from the root down, with digits
generalised. Per host the votes are added up in Spark, and every page is read again with its host's winning path.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sedimenta.llm.work import ROW, stage, with_row_number

# Tags of HTML, fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style textarea title noscript iframe template svg math select option head canvas object audio video"
CLOSES_PARAGRAPH = frozenset("address article aside blockquote body details div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section table tbody td tfoot th thead tr ul".split())
#: Containers a page can vote for.
CONTAINERS = frozenset("body div article main section td".split())
#: Inside these no text is part of the article.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog button header".split())
#: Words of class, id and role that mark such parts.
ASIDE_WORDS = frozenset("""ad ads advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice
 alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside footer header masthead toolbar pagination pager comment
 comments reply replies respond disqus share sharing social related recommended newsletter subscribe subscription signup login search widget
 complementary contentinfo navigation search""".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>" + RAW.replace(" ", "|") + r""")\b(?:[^>"']|"[^"]*"|'[^']*')*?(?P<empty>/)?>|<(?P<close>/)?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORDS = re.compile(r"[a-z]+")
RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW.split()}


#: Elements of running text: their ids are anchors, and only a whole class sets them apart.
RUNNING = frozenset("h1 h2 h3 h4 h5 h6 p li ul ol dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr th td hr".split())


def _marks(tag: str, attrs: str, inside: bool) -> tuple[str, bool]:
    """(classes with digits generalised, whether the element is no part of an article).

    Outside an article any word of class, id or role can say so. ``inside`` one a word of class or role can, and an id as a whole, as ids there
    name what a section is about; elements of running text are marked by a whole class or role only.
    """
    kind, aside = "", False
    for name, *values in ATTRIBUTE.findall(attrs):
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden":
            aside = True
        elif name != "itemprop":
            if tag in RUNNING:
                marked = name != "id" and not ASIDE_WORDS.isdisjoint(value.split())
            elif inside and name == "id":
                marked = value.strip() in ASIDE_WORDS
            else:
                marked = not ASIDE_WORDS.isdisjoint(WORDS.findall(value))
            aside = aside or marked
            if name == "class":
                kind = ".".join(sorted(re.sub(r"\d+", "#", value).split()))
    return kind, aside


class Page:
    """Blocks of text with the containers they stand in.

    ``paths``: path of each container, in page order; ``up``: its parent container or -1. ``blocks``: (container, text, characters
    in links). ``whole`` names the article or main element around a container, if there is one.
    """

    def __init__(self, source: str):
        self.paths: list[str] = []
        self.up: list[int] = []
        self.whole: list[int] = []
        self.blocks: list[tuple[int, str, int]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        # An open element: tag, whether it or one around it is aside, its container, its path.
        opened: list[tuple[str, bool, int, str]] = [("", False, -1, "")]
        text: list[str] = []
        in_link = 0

        def end_block() -> None:
            nonlocal in_link
            joined = " ".join("".join(text).split())
            if joined:
                self.blocks.append((opened[-1][2], joined, in_link))
            text.clear()
            in_link = 0

        def pop_to(tags: frozenset | set, stop: frozenset | set = frozenset()) -> None:
            for i in range(len(opened) - 1, 0, -1):
                if opened[i][0] in tags:
                    end_block() if opened[i][0] in CLOSES_PARAGRAPH else None
                    del opened[i:]
                    return
                if opened[i][0] in stop:
                    return

        def add(piece: str) -> None:
            nonlocal in_link
            if piece and not opened[-1][1]:
                piece = references.unescape(piece) if "&" in piece else piece
                text.append(piece)
                if any(o[0] == "a" for o in opened):
                    in_link += len(piece)

        at = 0
        while True:
            found = TOKEN.search(source, at)
            if not found:
                add(source[at:])
                break
            add(source[at: found.start()])
            at = found.end()
            raw, tag = found.group("raw"), found.group("tag")
            if raw:
                raw = raw.lower()
                if not found.group("empty") and raw != "option":
                    end = RAW_END[raw].search(source, at)
                    at = end.end() if end else (at if raw == "head" else len(source))
                continue
            if not tag:
                if found.group().startswith("<![CDATA["):
                    add(found.group()[9:-3].replace("&", "&amp;"))
                continue
            tag = tag.lower()
            if found.group("close"):
                if tag in CLOSES_PARAGRAPH:
                    end_block()
                    pop_to({tag})
                elif tag == "br":
                    text.append(" ")
                else:
                    pop_to({tag}, CLOSES_PARAGRAPH)
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag in CLOSES_PARAGRAPH:
                end_block()
                pop_to({"p"}, {"td", "th", "li", "div", "article", "section", "main", "blockquote"})
                if tag == "li":
                    pop_to({"li"}, {"ul", "ol", "menu"})
                elif tag in ("dd", "dt"):
                    pop_to({"dd", "dt"}, {"dl"})
                elif tag in ("td", "th"):
                    pop_to({"td", "th"}, {"tr", "table"})
                elif tag == "tr":
                    pop_to({"tr"}, {"table"})
            if tag in VOID or found.group("attrs").endswith("/"):
                continue
            _, aside, container, path = opened[-1]
            if tag in CONTAINERS or tag in CLOSES_PARAGRAPH:
                inside = container >= 0 and self.whole[container] >= 0
                kind, marked = _marks(tag, found.group("attrs"), inside)
                aside = aside or marked and tag not in ("body", "html", "article", "main") or tag in ASIDE_TAGS and not (tag == "header" and inside)
                path = f"{path}>{tag}{'.' + kind if kind else ''}"
                if tag in CONTAINERS:
                    self.paths.append(path)
                    self.up.append(container)
                    around = self.whole[container] if container >= 0 else -1
                    container = len(self.paths) - 1
                    self.whole.append(around if around >= 0 else container if tag in ("article", "main") or "articlebody" in found.group("attrs").lower() else -1)
            opened.append((tag, aside, container, path))
        end_block()

    def best(self) -> str:
        """Path of the best container: of the text outside links, each block counts for its container and half as much for each one further out.

        An article or main element stands for all containers inside it. "" where there is no text.
        """
        score = [0.0] * len(self.paths)
        for container, text, in_link in self.blocks:
            n = max(0, len(text) - 2 * in_link)
            share = 1.0
            while container >= 0:
                score[container] += share * n
                share /= 2
                container = self.up[container]
        top, value = -1, 0.0
        for i in range(len(score)):
            here = score[i] * (4 if self.whole[i] == i else 1)
            if here > value:
                top, value = i, here
        if top < 0:
            return ""
        return self.paths[self.whole[top] if self.whole[top] >= 0 else top]

    def text(self, path: str) -> str | None:
        """Blocks in the containers with this path, in page order, joined by line ends; None where the page has no such container."""
        inside = []
        for i, own in enumerate(self.paths):
            inside.append(own == path or self.up[i] >= 0 and inside[self.up[i]])
        if not any(inside):
            return None
        return "\n".join(text for container, text, _ in self.blocks if container >= 0 and inside[container])

    def extract(self, winner: str | None) -> str:
        """Text at the winning path, or else at the page's own best one; a page without containers gives all its blocks."""
        if winner and (text := self.text(winner)):
            return text
        own = self.best()
        return (self.text(own) or "") if own else "\n".join(text for _, text, _ in self.blocks)


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; NULL where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([batch.column(0), pa.array([Page(h).best() for h in batch.column(1).to_pylist()], pa.string())], names=["_host", "_path"])


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(_host, _winner): the path most pages of the host voted for; the first by code point on a tie. Pages without host or text
    don't vote. The votes are counted where they are made, so a hot host moves one row per path and task."""
    rows = pages.select(host_of(F.col(url_col)).alias("_host"), F.coalesce(F.col(html_col), F.lit("")).alias("_html")).filter(F.col("_host").isNotNull())
    votes = rows.mapInArrow(_votes, "_host string, _path string").filter("_path != ''").groupBy("_host", "_path").agg(F.count("*").alias("_votes"))
    first = Window.partitionBy("_host").orderBy(F.desc("_votes"), "_path")
    return votes.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select("_host", F.col("_path").alias("_winner"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: id, url, text, n_chars (code points).

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup and reader comments are left out. Character
    references are decoded, white space inside a block is one space, blocks are joined in page order by one line end. NULL
    and empty pages give an empty text; a page without host uses its own best container, and so does one that lacks its host's path.
    Other columns are not read. ``pages`` must be a stored table: it is read for the votes and again for the texts, and the narrow
    (row, winner) pairs are joined to hosts before they meet the pages by row.
    """
    rows = with_row_number(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html")))
    winners = stage(host_paths(rows, "_url", "_html"))
    hosts = rows.select(ROW, host_of(F.col("_url")).alias("_host"))
    known = stage(hosts.join(winners, "_host").select(ROW, "_winner"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(h or "").extract(w) for h, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], names=["_id", "_url", "text", "n_chars"])

    schema = T.StructType([rows.schema["_id"], rows.schema["_url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    joined = rows.join(known, ROW, "left").select("_id", "_url", "_html", "_winner")
    return joined.mapInArrow(texts, schema).withColumnRenamed("_id", id_col).withColumnRenamed("_url", url_col)
