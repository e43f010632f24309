"""Main text of web pages: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks. A block is described by its number
of words and link density, those of its neighbours, and the kind of element
it stands in; a decision tree, trained on a small labelled table, says which
blocks are main text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements whose text never shows, or belongs to a control.
SKIPPED = set("script style noscript template title head svg iframe object canvas select datalist option textarea button".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not start a block.
INLINE = set(
    "math mi mn mo mrow ms msub msup msubsup mfrac msqrt mroot mtext "
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var".split()
)
#: Elements that hold no main text, and those that hold it.
SIDE_TAGS = set("nav header footer aside form menu dialog".split())
MAIN_TAGS = {"article", "main"}
#: Words of a class, id or role (cut at anything but letters) that tell the same.
SIDE_WORDS = set(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
    nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc
    header masthead topbar footer bottombar sidebar aside rail widget complementary contentinfo
    cookie cookies consent gdpr notice notices alert alertdialog popup modal overlay newsletter subscribe subscription signup login paywall disclaimer
    comment comments commentlist reply replies disqus respond feedback
    related recommended recommendations teaser teasers share sharing social
    form search searchbox skip""".split()
)
#: Words that may stand beside them in a name without making it another one ("site-header", not "social-history").
NEUTRAL_WORDS = set(
    """area article bar block body bottom box button buttons col column container content desktop entry first fixed global
    group holder inner item items js last layout left link links list main mobile module outer page panel post posts primary
    right row secondary section site slot sticky text thread top ul unit user web wrap wrapper""".split()
)
#: Names of a heading, where they stand in an article.
HEADING_WORDS = {"header", "masthead"}
#: Side elements in which a nested article is still side text (a comment, a teaser).
STICKY_TAGS = {"aside", "footer", "form"}
STICKY_WORDS = set("comment comments commentlist reply replies disqus respond related recommended recommendations teaser teasers".split())

FEATURES = ["side", "main", "words", "links", "words_before", "links_before", "words_after", "links_after"]
#: The labelled table: features of a block (see ``blocks``) and whether it is main text.
LABELLED = [
    # in an article: paragraphs, headings and short lines
    (0, 1, 62, 0.0, 9, 0.0, 48, 0.0, 1),
    (0, 1, 48, 0.05, 62, 0.0, 75, 0.1, 1),
    (0, 1, 9, 0.0, 4, 0.0, 62, 0.0, 1),
    (0, 1, 7, 0.0, 1, 1.0, 40, 0.0, 1),
    (0, 1, 1, 0.0, 48, 0.0, 31, 0.0, 1),
    (0, 1, 2, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 1, 3, 0.0, 55, 0.0, 3, 0.0, 1),
    (0, 1, 120, 0.3, 20, 0.0, 14, 0.0, 1),
    (0, 1, 14, 1.0, 60, 0.0, 52, 0.0, 1),
    (0, 1, 5, 1.0, 33, 0.0, 28, 0.0, 1),
    (0, 1, 24, 0.6, 50, 0.1, 41, 0.0, 1),
    (0, 1, 2, 1.0, 70, 0.0, 18, 0.2, 1),
    (0, 1, 18, 0.0, 6, 0.0, 12, 0.0, 1),
    (0, 1, 11, 0.0, 44, 0.0, 9, 0.0, 1),
    (0, 1, 4, 0.0, 8, 1.0, 90, 0.0, 1),
    (0, 1, 35, 0.0, 3, 1.0, 3, 1.0, 1),
    (0, 1, 52, 0.0, 40, 0.0, 6, 1.0, 1),
    (0, 1, 8, 0.0, 60, 0.1, 3, 1.0, 1),
    (0, 1, 30, 0.2, 25, 0.0, 4, 0.9, 1),
    (0, 1, 3, 0.0, 2, 1.0, 5, 1.0, 1),
    (0, 1, 66, 0.0, 5, 1.0, 7, 1.0, 1),
    (0, 1, 12, 0.7, 40, 0.0, 35, 0.0, 1),
    (0, 1, 1, 1.0, 48, 0.0, 0, 0.0, 1),
    (0, 1, 6, 0.9, 0, 0.0, 55, 0.0, 1),
    # references and other lists of links in an article are part of it
    (0, 1, 3, 1.0, 4, 1.0, 2, 1.0, 1),
    (0, 1, 6, 1.0, 5, 1.0, 7, 1.0, 1),
    (0, 1, 2, 1.0, 2, 1.0, 3, 1.0, 1),
    (0, 1, 9, 1.0, 8, 1.0, 10, 1.0, 1),
    (0, 1, 2, 1.0, 2, 1.0, 0, 0.0, 1),
    (0, 1, 4, 1.0, 3, 1.0, 20, 0.0, 1),
    # elsewhere they are not
    (0, 0, 2, 1.0, 3, 1.0, 45, 0.0, 0),
    (0, 0, 5, 1.0, 4, 1.0, 0, 0.0, 0),
    # side elements, in or out of an article, whatever their length
    (1, 0, 1, 1.0, 0, 0.0, 1, 1.0, 0),
    (1, 0, 2, 1.0, 1, 1.0, 2, 1.0, 0),
    (1, 0, 1, 1.0, 1, 1.0, 9, 0.0, 0),
    (1, 0, 9, 0.0, 1, 1.0, 11, 0.0, 0),
    (1, 0, 70, 0.0, 60, 0.0, 12, 0.0, 0),
    (1, 0, 34, 0.1, 50, 0.0, 0, 0.0, 0),
    (1, 0, 18, 0.2, 44, 0.0, 6, 1.0, 0),
    (1, 0, 5, 0.0, 62, 0.0, 58, 0.0, 0),
    (1, 0, 110, 0.0, 90, 0.0, 85, 0.0, 0),
    (1, 0, 3, 0.0, 3, 0.0, 3, 0.0, 0),
    (1, 0, 45, 0.0, 8, 0.0, 40, 0.0, 0),
    (1, 0, 12, 0.0, 0, 0.0, 64, 0.0, 0),
    (1, 1, 40, 0.0, 55, 0.0, 48, 0.0, 0),
    (1, 1, 8, 0.0, 55, 0.0, 61, 0.0, 0),
    (1, 1, 22, 0.3, 61, 0.0, 0, 0.0, 0),
    (1, 1, 90, 0.0, 80, 0.0, 70, 0.0, 0),
    (1, 1, 2, 1.0, 50, 0.0, 3, 1.0, 0),
    (1, 1, 15, 0.0, 3, 0.0, 15, 0.0, 0),
    (1, 1, 4, 0.0, 30, 0.0, 45, 0.0, 0),
    # neither: running text and its headings
    (0, 0, 60, 0.0, 8, 0.0, 45, 0.0, 1),
    (0, 0, 45, 0.1, 60, 0.0, 52, 0.0, 1),
    (0, 0, 8, 0.0, 2, 1.0, 60, 0.0, 1),
    (0, 0, 6, 0.0, 52, 0.0, 47, 0.0, 1),
    (0, 0, 30, 0.0, 3, 1.0, 5, 0.0, 1),
    (0, 0, 16, 0.0, 40, 0.0, 3, 0.5, 1),
    (0, 0, 85, 0.2, 0, 0.0, 0, 0.0, 1),
    (0, 0, 12, 0.0, 33, 0.0, 28, 0.0, 1),
    (0, 0, 4, 0.0, 41, 0.0, 36, 0.0, 1),
    (0, 0, 20, 0.0, 18, 0.0, 22, 0.0, 1),
    (0, 0, 1, 0.0, 38, 0.0, 50, 0.0, 1),
    (0, 0, 50, 0.0, 44, 0.0, 3, 1.0, 1),
    (0, 0, 27, 0.1, 30, 0.0, 2, 1.0, 1),
    (0, 0, 18, 0.0, 4, 1.0, 2, 1.0, 1),
    (0, 0, 5, 0.0, 3, 1.0, 48, 0.0, 1),
    (0, 0, 9, 0.0, 50, 0.0, 0, 0.0, 1),
    (0, 0, 3, 1.0, 45, 0.0, 52, 0.0, 1),
    # neither: short lines among others like them
    (0, 0, 2, 0.0, 3, 0.0, 2, 0.0, 1),
    (0, 0, 1, 0.0, 3, 0.0, 2, 0.0, 1),
    (0, 0, 3, 0.0, 0, 0.0, 1, 0.0, 1),
    (0, 0, 2, 0.0, 1, 0.0, 0, 0.0, 1),
    (0, 0, 5, 0.0, 2, 0.0, 0, 0.0, 1),
    (0, 0, 2, 0.0, 0, 0.0, 0, 0.0, 1),
    # neither: link lists, and lines beside them
    (0, 0, 3, 0.0, 2, 1.0, 0, 0.0, 0),
    (0, 0, 6, 0.0, 4, 0.8, 0, 0.0, 0),
    (0, 0, 4, 0.9, 40, 0.0, 5, 0.0, 0),
    (0, 0, 7, 1.0, 0, 0.0, 5, 0.0, 0),
    (0, 0, 3, 1.0, 0, 0.0, 40, 0.0, 0),
    (0, 0, 8, 0.9, 0, 0.0, 3, 0.0, 0),
    (0, 0, 5, 0.8, 35, 0.0, 3, 0.0, 0),
    (0, 0, 2, 1.0, 3, 1.0, 2, 1.0, 0),
    (0, 0, 5, 1.0, 2, 1.0, 6, 1.0, 0),
    (0, 0, 12, 0.9, 10, 0.8, 14, 1.0, 0),
    (0, 0, 3, 1.0, 50, 0.0, 4, 1.0, 0),
    (0, 0, 4, 0.0, 2, 1.0, 3, 1.0, 0),
    (0, 0, 3, 0.0, 4, 1.0, 1, 1.0, 0),
    (0, 0, 1, 0.0, 0, 0.0, 2, 1.0, 0),
    (0, 0, 6, 0.7, 40, 0.0, 5, 0.8, 0),
    (0, 0, 25, 0.8, 4, 1.0, 6, 1.0, 0),
]
# Labels that hold whatever the neighbours are: the same block by neighbours of several kinds.
_NEIGHBOURS = [(0, 0.0), (1, 0.0), (3, 1.0), (60, 0.0)]
LABELLED += [
    (*block, *before, *after, label)
    for *block, label in [
        (0, 1, 1, 0.0, 1),
        (0, 1, 8, 0.0, 1),
        (0, 1, 70, 0.2, 1),
        (0, 1, 5, 1.0, 1),
        (0, 0, 40, 0.0, 1),
        (1, 0, 2, 1.0, 0),
        (1, 0, 50, 0.0, 0),
        (1, 1, 30, 0.0, 0),
    ]
    for before in _NEIGHBOURS
    for after in _NEIGHBOURS
]


def _side_words(names: str) -> set[str]:
    """Side words of the names of an element, each name of which says nothing else."""
    found: set[str] = set()
    for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", names).lower().split():
        words = set(re.findall("[a-z]+", name))
        if words <= SIDE_WORDS | NEUTRAL_WORDS:
            found |= words & SIDE_WORDS
    return found


class _Blocks(HTMLParser):
    """Collects ``(text, linked words, side, main)`` of each block, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, int, int, int]] = []
        self.open: list[tuple[str, int, int, int]] = []  # tag, side, main, sticky
        self.skip: list[str] = []
        self.inside: list[str] = []  # open below what is skipped
        self.parts: list[str] = []
        self.linked, self.in_link = 0, False

    def flush(self) -> None:
        words = "".join(self.parts).split()
        if words:
            _, side, main, _ = self.open[-1] if self.open else ("", 0, 0, 0)
            self.found.append((" ".join(words), min(self.linked, len(words)), side, main))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag in ("br", "hr"):
                self.flush()
            return
        if self.skip or tag in SKIPPED:
            if tag in SKIPPED and (not self.skip or self.skip[-1] == tag):
                self.skip.append(tag)
            if tag in ("body", "article", "main"):  # an unclosed head
                self.skip, self.inside = [], []
            else:
                if tag not in SKIPPED:
                    self.inside.append(tag)
                return
        if tag == "a":
            self.in_link = True
        if tag in INLINE and not attrs:
            return
        a = {k: (v or "") for k, v in attrs}
        words = _side_words(" ".join(a.get(k, "") for k in ("class", "id", "role")))
        hidden = "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "")
        if tag in INLINE and not (words or hidden):
            return
        self.flush()
        if tag not in INLINE:
            self.in_link = False
        _, side, main, sticky = self.open[-1] if self.open else ("", 0, 0, 0)
        if tag in MAIN_TAGS:
            main, side = 1, side if sticky else 0
        in_article = main and not side
        named = bool(words - HEADING_WORDS if in_article else words) and tag not in ("html", "body")
        if hidden or named or (tag in SIDE_TAGS and not (in_article and tag == "header")):
            side = 1
            sticky = sticky or int(hidden or tag in STICKY_TAGS or bool(words & STICKY_WORDS))
        self.open.append((tag, side, main, sticky))

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.inside:
                del self.inside[len(self.inside) - 1 - self.inside[::-1].index(tag) :]
                return
            if tag in self.skip:
                del self.skip[len(self.skip) - 1 - self.skip[::-1].index(tag) :]
                return
            if tag in INLINE or not any(o[0] == tag for o in self.open):
                return
            self.skip, self.inside = [], []  # the element around it ends
        if tag == "a":
            self.in_link = False
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None or tag not in INLINE:
            self.flush()
            self.in_link = self.in_link and tag in INLINE
        if at is not None and (tag not in INLINE or at == len(self.open) - 1):
            del self.open[at:]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in SKIPPED and tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data.split())

    def parse_marked_section(self, i, report=1):
        end = self.rawdata.find(">", i)
        return len(self.rawdata) if end < 0 else end + 1


def blocks(html: str | None) -> list[tuple[str, tuple[float, ...]]]:
    """Text and features of each block of a page, in page order.

    Character references are decoded and white space inside a block is one
    space. A page ends before its first and after its last block with blocks
    of no words. Text in scripts, styles and controls makes no block.
    """
    p = _Blocks()
    p.feed((html or "").replace("\x00", ""))
    p.close()
    p.flush()
    rows = []
    for text, linked, side, main in p.found:
        n = text.count(" ") + 1
        rows.append((text, side, main, n, linked / n))
    out = []
    for i, (text, side, main, n, links) in enumerate(rows):
        before = rows[i - 1][3:] if i else (0, 0.0)
        after = rows[i + 1][3:] if i + 1 < len(rows) else (0, 0.0)
        out.append((text, (side, main, n, links, *before, *after)))
    return out


def fit_block_tree(spark: SparkSession, labelled: list[tuple] = LABELLED, depth: int = 10) -> tuple:
    """Decision tree of the labelled table, as nested ``(feature, threshold, left, right)``; a leaf is a label."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = spark.createDataFrame([tuple(map(float, r)) for r in labelled], [*FEATURES, "label"])
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=256, minInstancesPerNode=1, seed=3).fit(rows)

    def node(n):
        if n.subtreeDepth() == 0:
            return int(n.prediction())
        return (n.split().featureIndex(), n.split().threshold(), node(n.leftChild()), node(n.rightChild()))

    return node(model._java_obj.rootNode())


def is_main(tree, features: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, left, right = tree
        tree = left if features[feature] <= threshold else right
    return tree == 1


def main_text(html: str | None, tree) -> str:
    return " ".join(text for text, f in blocks(html) if is_main(tree, f))


def extract_text(pages: DataFrame, html: str = "html", out: str = "text", tree: tuple | None = None) -> DataFrame:
    """``pages`` with the main text of each whole page in ``out``.

    One pass, no shuffle; the tree is a few dozen numbers. Blocks are joined
    in page order by one space. A null or empty page, or one without main
    text, gives an empty text. A column already named ``out`` is replaced.
    """
    tree = tree or fit_block_tree(pages.sparkSession)

    @F.pandas_udf(T.StringType())
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([main_text(h, tree) for h in s], dtype=object)

    return pages.withColumn(out, extract(F.col(html)))
