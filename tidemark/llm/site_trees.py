"""Main text of web pages by site style trees.

The trees of a site's pages are merged: block elements with the same tags,
classes and ids from the root down are one node of the site's tree. A node has
two importances between 0 and 1. Its content importance is 1 less the mean
entropy of its words over the pages that have the node: words that are on every
page are a template's, words of few pages are content. Its presentation
importance is the entropy of what stands in it, weighed by how many forms that
takes: containers of content vary, those of a template do not. A text is as
important as its node's content or, if that is more, as its container's
presentation; the share of it that is link text does not count.

What an element is for enters as a fixed weight: 0 for menus, page headers and
footers, forms, adverts, comments and the like, 1 for what a page marks as its
article. Beside a marked article unmarked branches weigh 0. Words of an advert
that are drawn anew for every page have the entropy of content, so entropy
alone could not tell them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.page_tree import MAIN, NEUTRAL, NOISE, Page
from tidemark.session import ship_package, stage

LEAST_IMPORTANCE = 0.3
DECAY = 0.9
MOST_SHIPPED = 2_000_000  # nodes, 32 bytes each in a task
_FORMS, _WORDS, _PAGES = 0, 1, 2
_MIX = np.uint64(0x9E3779B97F4A7C15)  # any odd number
_MOST_HELD = 1_000_000  # statistics in a task before they are handed on


@lru_cache(maxsize=1 << 14)
def site_of(url: str | None) -> str:
    """Host of a URL in lower case; '' if there is none."""
    try:
        return urlsplit((url or "").strip()).hostname or ""
    except ValueError:
        return ""


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


_STATISTICS = ["node", "feature", "n", "n_ln_n"]


class Statistics:
    """Counts of forms and words by node, held as columns until there are many."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.kinds: list[int] = []
        self.features: list[int] = []
        self.counts: list[int] = []

    def __len__(self) -> int:
        return len(self.nodes)

    def add(self, page: Page) -> None:
        """One entry for each node of a page, each form of a node and each of its words."""
        words: dict[int, list[str]] = {}
        for block in page.blocks:
            words.setdefault(page.nodes[block.node].key, []).extend(block.text.split())
        forms: dict[int, Counter] = {}
        for node in page.nodes:
            if node.children:
                form = zlib.crc32(repr(node.children).encode())
                forms.setdefault(node.key, Counter())[form] += 1
        for key, found in forms.items():
            self._put(key, _PAGES, (0,), (1,))
            self._put(key, _FORMS, found.keys(), found.values())
        for key, found in words.items():
            counts = Counter(found)
            self._put(key, _WORDS, map(zlib.crc32, map(str.encode, counts)), counts.values())

    def _put(self, key: int, kind: int, features, counts) -> None:
        before = len(self.counts)
        self.features.extend(features)
        self.counts.extend(counts)
        new = len(self.counts) - before
        self.nodes.extend([key] * new)
        self.kinds.extend([kind] * new)

    def summed(self) -> pa.RecordBatch:
        """Node, kind with feature, n and n ln n: entropies follow from their sums over pages."""
        node = np.array(self.nodes, np.uint64)
        kind, feature = np.array(self.kinds, np.int64), np.array(self.features, np.int64)
        n = np.array(self.counts, np.int64)
        # Entries are grouped by a 64-bit mix of the three, as one key sorts fastest.
        mixed = (node ^ (feature + (kind << 33)).view(np.uint64)) * _MIX
        order = np.argsort(mixed, kind="stable")
        node, kind, feature, n = (x[order] for x in (node, kind, feature, n))
        new = np.ones(len(n), bool)
        new[1:] = (np.diff(node) != 0) | (np.diff(kind) != 0) | (np.diff(feature) != 0)
        first = np.flatnonzero(new)
        spread = np.where(kind == _WORDS, n * np.log(n), 0.0)
        self.__init__()
        columns = [node[first].view(np.int64), (feature + (kind << 33))[first], n, spread]
        for k in (2, 3):
            columns[k] = np.add.reduceat(columns[k], first) if len(first) else columns[k]
        # Rows of a node side by side take less room in the shuffle.
        order = np.argsort(columns[0], kind="stable")
        return pa.RecordBatch.from_arrays([pa.array(c[order]) for c in columns], _STATISTICS)




def site_tree(pages: DataFrame, decay: float = DECAY) -> DataFrame:
    """One row per node of all sites: n_pages, content and presentation importance.

    A node seen on one page has importance 1, as nothing speaks against it.
    Sums are formed in the task, then by Spark, so a site of any size is cut
    over all tasks.
    """
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Statistics()
        for batch in batches:
            for url, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.add(Page(html.as_py() or "", site_of(url)))
                if len(held) > _MOST_HELD:
                    yield held.summed()
        yield held.summed()

    raw = pages.select(F.col("url").cast("string"), F.col("html").cast("string"))
    sums = (
        raw.mapInArrow(run, "node bigint, feature bigint, n bigint, n_ln_n double")
        .groupBy("node", "feature")
        .agg(F.sum("n").alias("n"), F.sum("n_ln_n").alias("x"))
    )
    n, kind = F.col("n"), F.shiftright("feature", 33)

    def of(which: int, value) -> F.Column:
        return F.sum(F.when(kind == which, value))

    by_node = sums.groupBy("node").agg(
        of(_PAGES, n).alias("n_pages"),
        of(_WORDS, F.lit(1)).alias("n_words"),
        of(_WORDS, F.greatest(F.lit(0.0), F.ln(n) - F.col("x") / n)).alias("entropies"),
        of(_FORMS, F.lit(1)).alias("n_forms"),
        of(_FORMS, n).alias("n_seen"),
        of(_FORMS, n * F.ln(n)).alias("seen_ln"),
    )
    content = 1 - F.col("entropies") / F.col("n_words") / F.ln("n_pages")
    form = (F.ln("n_seen") - F.col("seen_ln") / F.col("n_seen")) / F.ln("n_seen")
    weight = 1 - F.pow(F.lit(decay), F.col("n_forms"))
    alone = F.col("n_pages") == 1
    return by_node.select(
        "node",
        "n_pages",
        F.when(F.col("n_words").isNull(), 0.0)
        .when(alone, 1.0)
        .otherwise(F.greatest(F.lit(0.0), content))
        .alias("content"),
        F.when(alone, 1.0)
        .otherwise(weight * F.greatest(F.lit(0.0), form))
        .alias("presentation"),
    )


class Tree:
    """Importances by node key, as sorted arrays."""

    def __init__(self, node: np.ndarray, content: np.ndarray, presentation: np.ndarray) -> None:
        order = np.argsort(node)
        self.node, self.content = node[order], content[order]
        self.presentation = presentation[order]

    def __call__(self, key: int) -> tuple[float, float]:
        at = int(np.searchsorted(self.node, _signed(key)))
        return float(self.content[at]), float(self.presentation[at])


def kept_blocks(page: Page, importance, least: float = LEAST_IMPORTANCE) -> list[str]:
    """Texts of the branches that stay, in page order.

    ``importance`` gives a node key's content and presentation importance. A
    page without marks that would lose everything keeps all that has no role
    against it: there is nothing on it to choose by.
    """
    marked = page.marked()
    known: dict[int, tuple[float, float]] = {}

    def of(key: int) -> tuple[float, float]:
        if key not in known:
            known[key] = importance(key)
        return known[key]

    kept, others = [], []
    for block in page.blocks:
        node = page.nodes[block.node]
        if node.state == NOISE:
            continue
        own = of(node.key)[0]
        around = of(page.nodes[node.parent].key)[1] if node.parent >= 0 else 0.0
        value = max(own, around) * (1 - block.linked / len(block.text))
        if node.state == MAIN:
            value = 1.0
        elif marked:
            value = 0.0
        if value >= least:
            kept.append(block.text)
        elif node.state == NEUTRAL and not marked and block.linked < len(block.text):
            others.append(block.text)
    return kept or others


def _parsed_texts(pages: DataFrame, tree: Tree, least: float) -> DataFrame:
    @F.pandas_udf("string")
    def text(url: pd.Series, html: pd.Series) -> pd.Series:
        return pd.Series(
            [
                "\n\n".join(kept_blocks(Page(h or "", site_of(u)), tree, least))
                for u, h in zip(url, html)
            ],
            dtype=object,
        )

    return pages.select("page_id", "url", text("url", "html").alias("text"))


def _joined_texts(pages: DataFrame, tree: DataFrame, least: float) -> DataFrame:
    """The same by joins, for trees of any size: a page's nodes are looked up by Spark."""
    pages = stage(pages.select("page_id", "url", "html", F.expr("uuid()").alias("row")), "pages")

    @F.pandas_udf("array<bigint>")
    def nodes_of(url: pd.Series, html: pd.Series) -> pd.Series:
        return pd.Series(
            [
                sorted({_signed(n.key) for n in Page(h or "", site_of(u)).nodes if n.children})
                for u, h in zip(url, html)
            ]
        )

    nodes = pages.select("row", F.explode(nodes_of("url", "html")).alias("node"))
    held = nodes.join(tree, "node").groupBy("row").agg(
        F.collect_list(F.struct("node", "content", "presentation")).alias("tree")
    )

    @F.pandas_udf("string")
    def text(url: pd.Series, html: pd.Series, tree: pd.Series) -> pd.Series:
        out = []
        for u, h, rows in zip(url, html, tree):
            known = {r["node"]: (r["content"], r["presentation"]) for r in (rows if rows is not None else ())}
            of = lambda key: known[_signed(key)]
            out.append("\n\n".join(kept_blocks(Page(h or "", site_of(u)), of, least)))
        return pd.Series(out, dtype=object)

    joined = pages.join(held, "row", "left")
    return joined.select("page_id", "url", text("url", "html", "tree").alias("text"))


def main_texts(
    pages: DataFrame, least: float = LEAST_IMPORTANCE, most_shipped: int = MOST_SHIPPED
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Character references are decoded, white space inside a block becomes one
    space, and blocks are joined by two line feeds. NULL and empty pages, and
    pages of nothing but removed branches, have the empty text. Pages without a
    host form one site. Repeated rows count as pages of their own, and each has
    its row. Trees of at most ``most_shipped`` nodes go to every task; larger
    ones are joined to the pages.
    """
    ship_package(pages.sparkSession)
    pages = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    tree = stage(site_tree(pages).select("node", "content", "presentation"), "site_tree")
    if tree.count() <= most_shipped:
        table = tree.toArrow()
        columns = (table[name].to_numpy() for name in ("node", "content", "presentation"))
        texts = _parsed_texts(pages, Tree(*columns), least)
    else:
        texts = _joined_texts(pages, tree, least)
    return texts.select("*", F.length("text").cast("bigint").alias("n_chars"))
