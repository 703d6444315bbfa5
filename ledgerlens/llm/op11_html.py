"""HTML extraction (operator 11): site style trees and the importance of their branches.

The DOMs of a host's pages are merged into one tree (``markup``: elements that look
alike at the same place are one node). A node is judged by two entropies, both with the
number m of pages that hold it as base of the logarithm:

* presentation: the entropy of the different sequences of children that the pages have
  under it. 0 if all pages look the same there, 1 if each looks different;
* content: 1 less the mean entropy of the blocks of text below it, over the different
  blocks, by their length. A block that k pages repeat has entropy log_m k, so text on
  every page counts 0 and text of one page counts 1.

With l kinds of children the importance is (1 - 0.9**l) presentation + 0.9**l content; a
node of one page has importance 1. What a node says about itself is its prior: tags,
roles, classes and ids that name menus, headers, footers, sidebars, notices, adverts,
forms or comments (``markup.NOISE_*``) make the importance of a branch 0, and those that
name the article make it certain. Branches with an importance below ``LEAST`` are removed
from each page. Where a page names its article, what lies outside is removed as well.

The steps: one pass over all pages gives blocks, with the nodes above them, and per page
the shapes of its nodes; shapes and blocks are counted per node (partial sums in the
tasks first, so a host with a third of all pages is counted in many); low nodes meet the
pages' distinct nodes, and pages meet the few nodes that remove something from them.

Two things are never removed by importance: a branch that holds over half of what is
left inside a page's named article (the article of a host that repeats it everywhere),
and everything: where no block would be left, none is removed.

Defined results: null, empty and tag-only html gives the empty text. White space is what
``str.split`` splits at. ``br`` is white space inside its block. A null or invalid url is
the host "", and such pages form one tree. Pages that repeat get the same result each.
An empty table gives no rows. Elements nested deeper than 512 belong to the element at that
depth; their text stays. Only page_id, url and html are read, so other columns may
have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.frames import map_arrow, record, table, written
from ledgerlens.llm.markup import host, parse, signed
from ledgerlens.llm.words import batches

GAMMA, LEAST = 0.9, 0.2

_BLOCK = "text: string, feature: bigint, size: int, nodes: array<bigint>, first: array<bigint>"
_NODE = "node: bigint, shape: bigint, kinds: int"


def _lists(rows: list[list], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(
        [x for row in rows for x in row], kind))


def _nested(sizes: list[int], **columns) -> pa.ListArray:
    """A list of structs per row, of ``sizes`` elements, from flat columns."""
    return pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *sizes]).astype(np.int32)),
        pa.StructArray.from_arrays(list(columns.values()), names=list(columns)))


def parsed(pages: DataFrame) -> DataFrame:
    """Per page: row (unique), page_id, url, named (whether it names its article), whole
    (characters that importance may leave), blocks in page order (those that priors
    remove have no text; first: the nodes that hold a text for the first time in the
    page), tree."""
    def run(batch: pa.RecordBatch):
        every = list(zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()))
        for rows in batches(range(len(every)), lambda i: len(every[i][1] or "")):
            found = [parse(every[i][1], host(every[i][0])) for i in rows]
            blocks = [b for page in found for b in page.blocks]
            features = [signed(xxhash.xxh64_intdigest(b.text.encode("utf-8", "replace")))
                        for b in blocks]
            first, at = [], 0
            for page in found:
                seen = set()
                for b in page.blocks:
                    new = [n for n in b.judged if (n, features[at]) not in seen]
                    seen.update((n, features[at]) for n in new)
                    first.append(new)
                    at += 1
            best = [max((b.rank for b in page.blocks), default=0) for page in found]
            stays = [b.rank == top and top >= 0 for page, top in zip(found, best)
                     for b in page.blocks]
            tree = [(n, s, k) for page in found for n, (s, k) in page.tree.items()]
            pick = pa.array(rows, pa.int32())
            yield record(
                page_id=batch.column("page_id").take(pick), url=batch.column("url").take(pick),
                named=pa.array([top > 0 for top in best], pa.bool_()),
                whole=pa.array([sum(len(b.text) for b in page.blocks if b.rank == top)
                                for page, top in zip(found, best)], pa.int64()),
                blocks=_nested(
                    [len(page.blocks) for page in found],
                    text=pa.array([b.text if stay else None for b, stay in zip(blocks, stays)],
                                  pa.string()),
                    feature=pa.array(features, pa.int64()),
                    size=pa.array([len(b.text) for b in blocks], pa.int32()),
                    nodes=_lists([b.judged for b in blocks], pa.int64()),
                    first=_lists(first, pa.int64())),
                tree=_nested([len(page.tree) for page in found],
                             node=pa.array([t[0] for t in tree], pa.int64()),
                             shape=pa.array([t[1] for t in tree], pa.int64()),
                             kinds=pa.array([t[2] for t in tree], pa.int32())))

    kind = pages.schema["page_id"].dataType.simpleString()
    out = map_arrow(pages.select("page_id", F.col("url").cast("string").alias("url"),
                                 F.col("html").cast("string").alias("html")), run,
                    f"page_id {kind}, url string, named boolean, whole long, blocks array<struct<{_BLOCK}>>, "
                    f"tree array<struct<{_NODE}>>")
    return written(out.withColumn("row", F.monotonically_increasing_id()), "pages-parsed")


def importance(found: DataFrame) -> DataFrame:
    """Style tree: per node that holds text, its pages, kinds (of children),
    presentation, content and importance, without priors."""
    count = F.count(F.lit(1))
    shapes = (found.select(F.explode("tree").alias("t")).groupBy("t.node", "t.shape")
              .agg(count.alias("n"), F.max("t.kinds").alias("kinds"))
              .groupBy("node").agg(F.sum("n").alias("pages"), F.max("kinds").alias("kinds"),
                                   F.sum(F.col("n") * F.log("n")).alias("nlogn")))
    texts = (found.select(F.explode("blocks").alias("b"))
             .select(F.explode("b.first").alias("node"), "b.feature", "b.size")
             .groupBy("node", "feature").agg(count.alias("k"), F.max("size").alias("size"))
             .groupBy("node").agg(F.sum("size").alias("whole"),
                                  F.sum(F.col("size") * F.log("k")).alias("repeated")))
    base = F.log("pages")
    alone = F.col("pages") == 1
    joined = texts.join(shapes, "node").select(
        "node", "pages", "kinds",
        F.when(alone, 1.0).otherwise((base - F.col("nlogn") / F.col("pages")) / base)
        .alias("presentation"),
        F.when(alone, 1.0).otherwise(1 - F.col("repeated") / (base * F.col("whole")))
        .alias("content"))
    content = F.pow(F.lit(GAMMA), F.col("kinds"))
    return joined.withColumn("importance", (1 - content) * F.col("presentation")
                             + content * F.col("content"))


def extract(pages: DataFrame, least: float = LEAST) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    found = parsed(pages)
    low = written(importance(found).where(F.col("importance") < least).select("node"), "pages-low")
    main = found.select("row", "page_id", "url", "named", "whole",
                        F.filter("blocks", lambda b: b["text"].isNotNull()).alias("blocks"))
    # characters of each page's nodes: the rows of a page are summed where they are made
    shares = (main.select("row", "named", "whole", F.explode("blocks").alias("b"))
              .select("row", "named", "whole", F.explode("b.nodes").alias("node"), "b.size")
              .groupBy("row", "named", "whole", "node").agg(F.sum("size").alias("size")))
    gone = shares.join(low, "node").where(~F.col("named") | (2 * F.col("size") <= F.col("whole")))
    gone = written(gone.groupBy(F.col("row").alias("at")).agg(F.collect_set("node").alias("low")),
                   "pages-branches")
    left = F.filter("blocks", lambda b: ~F.arrays_overlap(b["nodes"], F.col("low")))
    pruned = main.join(gone, F.col("row") == F.col("at"), "left").select(
        "page_id", "url", "blocks", F.when(F.col("low").isNotNull(), left).alias("left"))
    text = F.array_join(F.transform(
        F.when(F.size("left") > 0, F.col("left")).otherwise(F.col("blocks")),
        lambda b: b["text"]), "\n")
    return pruned.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
