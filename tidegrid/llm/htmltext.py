"""Main text of web pages: parser events, text-to-tag ratios, smoothing, threshold, content regions.

1. ``html.parser`` streams events. Block elements end a line; a line has its text, the number of tags that came with it,
   the characters inside links, and the containers around it. Inline elements and ``br`` do not end a line.
2. Lines in menus, headers, footers, sidebars, notices, adverts, forms, reader comments and hidden parts, told by
   element, ``role`` or the words of ``class`` and ``id``, have ratio 0 and are never content. An ``article`` or ``main``
   inside a form or a wrapper of a header's name is content again; headings in the header of an article are its title.
3. The other lines' ratio of characters to tags is smoothed by a Gaussian along the page. Lines that reach
   one standard deviation of the smoothed ratios form the clusters.
4. Clusters tell which region is the article: the ``article`` or ``main`` elements that hold any, or without such
   elements the smallest container with ``SHARE`` of all clustered text. All lines of the region count, short ones
   as well; only in a region without such an element are lines that are mostly links and in no cluster left out.

Defined results: null and empty pages have an empty text; broken markup is read as far as the parser tells tags;
texts of any length are taken whole, by one task each; repeated rows give repeated results; an empty table gives an
empty one; columns whose names clash with the results keep theirs and the results get underscores. White space is
what Unicode calls so, the no-break space included.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.common import fresh, table

#: Spread of the smoothing in lines, and how far it reaches.
SIGMA, RADIUS = 1.0, 3
#: Share of the clustered characters that a container must hold to be the region.
SHARE = 0.9
#: A line with more of its characters in links is a list of links.
LINKS = 0.6

# Elements of HTML by their role here.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "audio button canvas datalist head iframe math map noframes noscript object rp rt script select style svg template "
    "textarea title video".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SECTIONS = frozenset("body main article section div center table tbody tr td form".split())
#: An element that ends when one of these starts in it.
ENDED_BY = {
    "p": BLOCKS - {"body", "html", "head"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "tr": {"tr"},
    "option": {"option", "optgroup"},
    "head": {"body"},
}
CLEAR, TITLE, SOFT, HARD = range(4)
ELEMENTS = {
    "aside": HARD, "footer": HARD, "dialog": HARD, "menu": HARD, "nav": SOFT, "header": SOFT, "form": SOFT,
    "fieldset": SOFT, "search": SOFT,
}
ROLES = {
    "navigation": SOFT, "banner": SOFT, "form": SOFT, "search": SOFT, "contentinfo": HARD, "complementary": HARD,
    "alert": HARD, "alertdialog": HARD, "dialog": HARD, "menu": HARD, "menubar": HARD, "toolbar": HARD, "note": HARD,
    "status": HARD,
}
#: Words of ``class`` and ``id`` that name what is no article, even if an article stands in it, or only if none does.
NAMED_HARD = re.compile(
    r"ads?\d*|ad(?:box|slot|unit|block|banner|sense|container|wrap|wrapper)s?|advert\w*|sponsor\w*|promo\w*"
    r"|comment(?:s|list|area|box|form|section|thread|er|ers|body)?\d*|disqus|respond|repl(?:y|ies)|related\w*|recommend\w*"
    r"|share|sharing|sharebar|social|cookies?|cookie(?:bar|banner|notice)|consent|gdpr|notices?|alerts?|popups?|modal|overlay"
    r"|newsletter|subscribe|subscription|signup|widgets?|breadcrumbs?|pagination|pager|sidebars?|\w+sidebar|footers?|\w+footer"
    r"|copyright|toolbar|hidden|teasers?"
)
NAMED_SOFT = re.compile(r"nav(?:bar|igation|s)?|\w+nav|menus?|\w+menu|headers?|masthead|banners?|topbar|login|search\w*|forms?")
#: Elements that a name cannot rule out, and words before a name that make it say what else is on the page.
UNNAMED = frozenset("html body main".split())
BESIDE = frozenset("has with no without".split())
#: Words of names that rule out an ``article`` element.
NOT_THE_ARTICLE = re.compile(r"comment(?:s|body)?\d*|repl(?:y|ies)|teasers?|related\w*|ads?\d*|advert\w*|sponsor\w*|promo\w*|widgets?")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
UNFINISHED = re.compile(r"<[a-zA-Z/!?]")


def standing(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """How an element's own name and attributes speak against its text."""
    found = ELEMENTS.get(tag, CLEAR)
    for name, value in attrs:
        value = value or ""
        if name == "hidden" and tag not in UNNAMED or name == "aria-hidden" and value.lower() == "true":
            return HARD
        if name == "style" and HIDDEN_STYLE.search(value):
            return HARD
        if name == "role":
            found = max(found, ROLES.get(value.strip().lower(), CLEAR))
        if name in ("class", "id") and tag not in UNNAMED:
            for part in value.split():
                before = ""
                for word in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", part).lower()):
                    if before not in BESIDE:
                        if tag == "article":
                            found = max(found, HARD if NOT_THE_ARTICLE.fullmatch(word) else CLEAR)
                        elif NAMED_HARD.fullmatch(word):
                            found = HARD
                        elif NAMED_SOFT.fullmatch(word):
                            found = max(found, SOFT)
                    before = word
    return found


class Lines(HTMLParser):
    """The lines of a page and the containers around them, from parser events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: containers: element, parent, standing, and the innermost article or main element around, if any
        self.tags, self.parents, self.against, self.homes = ["#root"], [-1], [CLEAR], [-1]
        self.stack = [0]
        #: lines: text, tags, characters in links, container
        self.lines: list[tuple[str, int, int, int]] = []
        self.pieces: list[str] = []
        self.count = 0
        self.link_chars = 0
        self.links = 0

    def parse_marked_section(self, i, report=0):
        return self.parse_bogus_comment(i)

    def updatepos(self, i, j):
        return j  # places in the page are not asked for

    def end_line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.lines.append((text, self.count, self.link_chars, self.stack[-1]))
            self.count = 0
        self.pieces.clear()
        self.link_chars = 0

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCKS
        if block:
            self.end_line()
            while self.tags[self.stack[-1]] in ENDED_BY and tag in ENDED_BY[self.tags[self.stack[-1]]]:
                self.stack.pop()
        self.count += 1
        if tag == "br":
            self.pieces.append(" ")
        elif tag == "a":
            self.links += 1
        if tag in VOID:
            return
        own = HARD if tag in SILENT else standing(tag, attrs) if block or attrs else CLEAR
        if not block and own == CLEAR:
            return
        around = self.stack[-1]
        home, against = self.homes[around], self.against[around]
        if tag in ("article", "main") and own == CLEAR:
            home = len(self.tags)
            if against < HARD:
                against = CLEAR
        elif tag == "header" and own == SOFT and home >= 0:
            own = TITLE
        elif tag in HEADINGS and against == TITLE:
            against = CLEAR
        self.stack.append(len(self.tags))
        self.tags.append(tag)
        self.parents.append(around)
        self.against.append(max(own, against))
        self.homes.append(home)

    def handle_startendtag(self, tag, attrs):
        # the slash says nothing but for void elements
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.count += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in ("html", "body") or tag in VOID:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            here = self.tags[self.stack[depth]]
            if here == tag:
                if any(t in BLOCKS for t in map(self.tags.__getitem__, self.stack[depth:])):
                    self.end_line()
                del self.stack[depth:]
                break
            # a stray end tag does not reach beyond these
            if here in ("article", "main", "td", "body") and tag not in ("article", "main", "table", "tr", "tbody"):
                break

    def handle_data(self, data):
        if self.against[self.stack[-1]] == HARD:
            if self.tags[self.stack[-1]] not in BLOCKS:
                return  # within a line: an advert, a button, a script
        self.pieces.append(data)
        if self.links:
            self.link_chars += len(data.strip())


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """A Gaussian along the lines; at the ends the weights of what is there are scaled to one."""
    reach = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    middle = slice(RADIUS, RADIUS + len(ratios))
    return np.convolve(ratios, kernel)[middle] / np.convolve(np.ones(len(ratios)), kernel)[middle]


def within(parents: list[int], node: int, region: int) -> bool:
    while node > region:
        node = parents[node]  # a container stands after its parent
    return node == region


def main_text(html: str | None) -> str:
    """The blocks of the article, one to a line."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    if UNFINISHED.match(page.rawdata):
        page.rawdata = ""  # markup that the page's end cuts off is no text
    page.close()
    page.end_line()
    lines = page.lines
    clear = [i for i, line in enumerate(lines) if page.against[line[3]] == CLEAR]
    if not clear:
        return ""
    ratios = np.zeros(len(lines))
    for i in clear:
        ratios[i] = len(lines[i][0]) / max(1, lines[i][1])
    smooth = smoothed(ratios)
    threshold = smooth.std()
    content = {i for i in clear if smooth[i] >= threshold}
    homes = {page.homes[lines[i][3]] for i in clear} - {-1}
    if homes:
        held = {page.homes[lines[i][3]] for i in content} & homes or homes
        # the title may stand in main beside the article
        kept = [i for i in clear if page.homes[lines[i][3]] in held
                or page.tags[lines[i][3]] == "h1" and page.homes[lines[i][3]] >= 0]
        return "\n".join(lines[i][0] for i in kept)
    weight = [0] * len(page.tags)
    for i in content or clear:
        weight[lines[i][3]] += len(lines[i][0])
    for node in range(len(weight) - 1, 0, -1):
        weight[page.parents[node]] += weight[node]
    region = 0
    for node in range(1, len(weight)):
        if page.parents[node] == region and page.tags[node] in SECTIONS | {"html"} and weight[node] >= SHARE * weight[0]:
            region = node
    return "\n".join(
        lines[i][0] for i in clear
        if within(page.parents, lines[i][3], region) and (i in content or lines[i][2] <= LINKS * len(lines[i][0]))
    )


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with ``text``, the main text, and ``n_chars``, its code points."""
    kept = pages.columns if keep is None else keep
    names = [fresh(kept, n) for n in ("text", "n_chars")]
    hidden = fresh([*kept, *names], "_html")
    given = pages.select(*[pages[f"`{c}`"] for c in kept], pages[f"`{html}`"].alias(hidden))
    schema = T.StructType(
        [f for f in given.schema.fields if f.name != hidden] + [T.StructField(names[0], T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(value.as_py()) for value in batch.column(hidden)], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], texts], names=schema.names)

    return given.mapInArrow(run, schema).withColumn(names[1], F.length(names[0]).cast("long"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


#: The given pages have one ``article`` element each, with paragraphs and a heading as its blocks.
OP11_SQL = r"""
WITH inner_html AS (
  SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '') AS a FROM pages
), blocks AS (
  SELECT page_id, url, list_transform(regexp_split_to_array(a, '</?(?:p|h1)>'),
    lambda b: trim(regexp_replace(regexp_replace(replace(replace(replace(replace(
      regexp_replace(b, '<[^>]*>', ' ', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS b
  FROM inner_html
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars
FROM (SELECT page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10)) AS text FROM blocks)
"""
