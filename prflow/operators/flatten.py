"""Connections: one row per edge, page progress, and ordered lists.

A parent's list is kept as *segments*: rows (parent, segment, items) where a
segment covers a fixed number of pages. Pages are bounded by the API, so a
segment is bounded too, however many items one parent has; nearly every parent
has the single segment 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PAGES_PER_SEGMENT = 10
ENVELOPE = ("owner", "name", "request_id", "page_no")


def _field_type(df: DataFrame, path: str):
    kind = df.schema
    for part in path.split("."):
        kind = kind[part].dataType
    return kind


def landed_order(pages: DataFrame) -> Column:
    """When a page landed, as a number; missing counts as first."""
    if "landed_at" not in pages.columns:
        return F.lit(0).cast("long")
    return F.coalesce(F.col("landed_at").cast("long"), F.lit(0).cast("long"))


_PARENT = ("owner", "name", "request_id")


def asked_again(pages: DataFrame, keys: Sequence[str] = _PARENT) -> DataFrame:
    """Parents with pages older than their latest page 0, and when that landed
    (``_begun``). Few, and only keys and times are read."""
    return (
        pages.select(*[F.col(k).alias(f"_{k}") for k in keys], "page_no", landed_order(pages).alias("_landed"))
        .groupBy(*[f"_{k}" for k in keys])
        .agg(F.max(F.when(F.col("page_no") == 0, F.col("_landed"))).alias("_begun"), F.min("_landed").alias("_oldest"))
        .filter("_oldest < _begun").drop("_oldest")
    )


def current_fetch(pages: DataFrame, keys: Sequence[str] = _PARENT, again: DataFrame | None = None) -> DataFrame:
    """Pages of each parent's latest fetch, copies included.

    A parent that is asked again is asked from page 0, so its latest page 0
    starts the current fetch, and pages that landed before it are gone.
    ``landed_at`` orders landings (a time or a running number; missing counts
    as first). A parent without a page 0 keeps all its pages. ``again`` may be
    ``asked_again`` of the same pages, written, so that its size is known."""
    begun = asked_again(pages, keys) if again is None else again
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    latest = pages.join(begun, same, "left").filter(
        F.col("_begun").isNull() | (landed_order(pages) >= F.col("_begun"))
    )
    return latest.select(*pages.columns)


def current_pages(pages: DataFrame, keys: Sequence[str] = _PARENT, again: DataFrame | None = None) -> DataFrame:
    """One copy of each page, all of one fetch: what a parent looks like now.

    Of the copies of a page in the current fetch the last landed counts; if
    they landed together, the one with the smallest content hash. Whole pages
    are chosen, so no list is put together from two versions."""
    latest = current_fetch(pages, keys, again)
    order = Window.partitionBy(*keys, "page_no").orderBy(landed_order(latest).desc(), F.xxhash64("body"))
    return latest.withColumn("_copy", F.row_number().over(order)).filter("_copy = 1").select(*pages.columns)


def take_edges(
    pages: DataFrame,
    path: str,
    keep: Sequence[str] = ENVELOPE,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """The page's envelope and its edges as one array column ``edges`` of
    (cursor, node fields), without exploding them.

    With ``fields`` only these fields of the nodes are taken, each by its own
    path, so that a parquet scan reads nothing else of them. (Spark does not
    prune what is taken out of an exploded struct.)"""
    edges = F.col(f"body.data.{path}.edges")
    edge_type: StructType = _field_type(pages, f"body.data.{path}.edges").elementType
    node_type: StructType = edge_type["node"].dataType
    has_cursor = "cursor" in edge_type.names
    if fields is None:
        if has_cursor:
            return pages.select(*keep, edges.alias("edges"))
        no_cursor = F.lit(None).cast("string").alias("cursor")
        return pages.select(
            *keep,
            F.transform(edges, lambda e: F.struct(no_cursor, e["node"].alias("node"))).alias("edges"),
        )
    parts = [edges["cursor"]] if has_cursor else [F.transform(edges["node"], lambda _: F.lit(None))]
    parts += [edges["node"][field] for field in fields]
    kind = ",".join(f"{f}:{node_type[f].dataType.simpleString()}" for f in fields)
    zipped = F.arrays_zip(*parts).cast(f"array<struct<cursor:string,{kind}>>")
    return pages.select(*keep, zipped.alias("edges"))


def explode_edges(
    rows: DataFrame, keep: Sequence[str] = ENVELOPE, fields: Sequence[str] | None = None
) -> DataFrame:
    """One row per edge of ``take_edges``: position in the page, cursor, node."""
    node = F.col("edge.node") if fields is None else F.struct(*[f"edge.{f}" for f in fields])
    return rows.select(*keep, F.posexplode("edges").alias("pos", "edge")).select(
        *keep, "pos", F.col("edge.cursor").alias("cursor"), node.alias("node")
    )


def flatten_connection(
    pages: DataFrame,
    path: str,
    keep: Sequence[str] = ENVELOPE,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """One row per edge of the connection at ``body.data.<path>``. NULL objects
    inside a node stay NULL. Pages with no edges give no rows."""
    return explode_edges(take_edges(pages, path, keep, fields), keep, fields)


def page_lists(
    pages: DataFrame,
    items: Column,
    keys: Sequence[str] = ("request_id",),
    pages_per_segment: int = PAGES_PER_SEGMENT,
    also: Sequence[str] = (),
) -> DataFrame:
    """Ordered lists ``(keys, segment, items)`` from page rows that arrive in
    any order and maybe repeatedly; ``items`` is the page's array.

    A page stays one array: no item is exploded, sorted or shuffled by itself,
    and a page crosses one exchange, by (keys, segment). Equal copies collapse
    before it. Of different ones the last landed counts, whole; of those that
    landed together the one with the smallest items. (After ``current_fetch``
    there is a copy for each time a page was landed again in one fetch.)
    Segments without items are left out. ``also`` names columns that follow
    from key and segment and by which the rows may be partitioned already;
    then there is no exchange at all."""
    page = F.struct("page_no", (-landed_order(pages)).alias("landed"), items.alias("items"))
    rows = pages.select(
        *keys, *also, F.floor(F.col("page_no") / pages_per_segment).alias("segment"), page.alias("_page")
    ).filter(F.size("_page.items") > 0)
    grouped = rows.groupBy(*keys, *also, "segment").agg(F.sort_array(F.collect_set("_page")).alias("_pages"))
    first = F.filter(
        "_pages", lambda one, i: (i == 0) | (F.get("_pages", i - 1)["page_no"] != one["page_no"])
    )
    return grouped.select(*keys, "segment", F.flatten(first["items"]).alias("items"))


def join_lists(lists: DataFrame, found: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """List rows with the other columns of ``found``, which has at most one row
    for a list row. Keys may be NULL."""
    place = [*keys, "segment"]
    renamed = found.select(*[F.col(k).alias(f"_{k}") for k in place], *[c for c in found.columns if c not in place])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in place]
    return lists.join(renamed, same, how).drop(*[f"_{k}" for k in place])


def stitch_pages(
    edges: DataFrame,
    value: Column,
    keys: Sequence[str] = ("request_id",),
    identity: str = "position",
    pages_per_segment: int = PAGES_PER_SEGMENT,
) -> DataFrame:
    """Ordered lists from edges that are rows of their own; ``page_lists`` does
    it for whole pages. They arrive in any order and maybe repeatedly.

    An item is identified by its ``position`` (page and place in the page) or
    by its ``cursor``; of several copies the first in page order is kept, and
    copies collapse map-side before the shuffle. Returns keys, segment, items.
    """
    keyed = edges.select(*keys, "page_no", "pos", "cursor", value.alias("value"))
    if identity == "position":
        once = keyed.groupBy(*keys, "page_no", "pos").agg(F.min("value").alias("value"))
    elif identity == "cursor":
        place = F.concat_ws("/", F.col("page_no").cast("string"), F.col("pos").cast("string"))
        once = (
            keyed.groupBy(*keys, F.coalesce("cursor", place).alias("_cursor"))
            .agg(F.min(F.struct("page_no", "pos", "value")).alias("_first"))
            .select(*keys, "_first.*")
        )
    else:
        raise ValueError(f"unknown identity {identity!r}")
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "pos", "value")))
    return (
        once.withColumn("segment", F.floor(F.col("page_no") / pages_per_segment))
        .groupBy(*keys, "segment")
        .agg(F.transform(ordered, lambda item: item["value"]).alias("items"))
    )


def page_progress(
    pages: DataFrame, path: str, keys: Sequence[str] = ("request_id",)
) -> DataFrame:
    """Per parent: pages and items so far, the cursor to continue from, and
    whether all pages are there.

    Works on page rows without exploding them. With ``pageInfo`` a parent is
    complete when its last page has no next one and no page is missing in
    between; without it ``complete`` is NULL and the declared count decides
    (see ``reconcile.incomplete_parents``)."""
    connection = f"body.data.{path}"
    kind: StructType = _field_type(pages, connection)
    edges = F.col(f"{connection}.edges")
    if "pageInfo" in kind.names:
        cursor = F.col(f"{connection}.pageInfo.endCursor")
        more = F.coalesce(F.col(f"{connection}.pageInfo.hasNextPage"), F.lit(False))
    else:
        cursor = F.try_element_at(edges, F.lit(-1))["cursor"]
        more = F.lit(None).cast("boolean")
    per_page = pages.select(
        *keys,
        "page_no",
        F.struct(
            F.coalesce(F.size(edges), F.lit(0)).alias("items"),
            cursor.alias("cursor"),
            more.alias("more"),
        ).alias("page"),
    )
    once = per_page.groupBy(*keys, "page_no").agg(F.max("page").alias("page"))
    last = F.max(F.struct("page_no", "page"))
    return (
        once.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum("page.items").alias("items"),
            last.alias("last"),
        )
        .select(
            *keys,
            "pages",
            "items",
            F.col("last.page.cursor").alias("next_cursor"),
            (~F.col("last.page.more") & (F.col("pages") == F.col("last.page_no") + 1)).alias(
                "complete"
            ),
        )
    )
