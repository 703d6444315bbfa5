"""Item history: cancellation reversals and the settlement line measures.

A canceled line does not carry its own gross and collected amounts: it reverses
the item's history, ``-max(amount)`` over every line of the item (0 when the
item has no amount at all). The settlement report also joins every line to all
lines with the same (item, status), so a group of n such lines counts each of
its measures n times and receives the group's consolidated sum.

Both are computed from aggregates instead of windows over raw keys or
self-joins. The settlement lines are summed once per (settlement group, item,
status), a map-side partial aggregation in which a hot item collapses; windows
over those rows give each item its reversal amounts and each (item, status) its
count and sums, and one more aggregation gives the settlement groups: one scan
of the history. Where hardly an item has more than a few lines, that first
aggregation collapses nothing and only sends every line twice. So the lines of a
large history are counted by item first, and dealt by item as they are, but those of
hot items, which are summed before. The partner report sums once per (partner, item).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas as S
from ledgerlens.functions import sqltext as sql
from ledgerlens.functions.columns import AMOUNT_SUM, TAXED_AMOUNT_SUM, sum_as
from ledgerlens.session import input_bytes

SETTLEMENT_KEYS = ("session_id", "invoice_id", "period_from", "period_to", "input_date",
                   "settlement_link")


def item_history(base: DataFrame) -> DataFrame:
    """A8: item -> reversal amounts ``-max(gross)``, ``-max(collected)`` (NULL -> 0).
    NULL item ids form their own group, as in a plain GROUP BY."""
    return base.groupBy("item_id").agg(
        reversal("gross_amount").alias("hist_gross"),
        reversal("collected_amount").alias("hist_collected"),
    )


def reversal(col: str) -> F.Column:
    """What a canceled line of a group reverses, from ``col`` of the group's rows."""
    return F.coalesce(-F.max(col), F.lit(0))


# tasks over which lines without an item are spread in the item join
NULL_ITEM_SALTS = 256


def consolidated_items(base: DataFrame) -> DataFrame:
    """A9: every line with its consolidated gross and collected amounts.

    One left join on (item, salt): the salt is a hash of the item, and of other
    columns for NULL items, which match nothing and are only spread by it. The
    history is shuffled again on that pair, so both sides come from a shuffle and
    AQE can split a hot item's lines."""
    def salt(*cols: str) -> F.Column:
        return F.pmod(F.xxhash64(*cols), F.lit(NULL_ITEM_SALTS)).cast("int")

    hist = item_history(base.where(F.col("item_id").isNotNull())).withColumn(
        "_salt", salt("item_id"))
    canceled = F.col("item_status") == S.STATUS_CANCELED
    salted = F.when(F.col("item_id").isNotNull(), salt("item_id")).otherwise(
        salt("session_id", "invoice_id", "gross_amount", "collected_amount"))
    joined = base.withColumn("_salt", salted).join(hist, ["item_id", "_salt"], "left")
    return joined.select(
        "item_id", "item_status", "session_id", "invoice_id",
        F.when(canceled, F.col("hist_gross")).otherwise(F.col("gross_amount"))
        .alias("gross_transaction"),
        F.when(canceled, F.col("hist_collected")).otherwise(F.col("collected_amount"))
        .alias("collected"),
    )


def item_status_rows(base: DataFrame, *more: str) -> DataFrame:
    """The lines summed per (settlement group, item, status) and ``more`` keys: count
    ``n``, sums and maxima of the amounts, and the commission with tax."""
    return base.groupBy(*more, *SETTLEMENT_KEYS, "item_id", "item_status").agg(
        F.expr("CAST(count(1) AS INT) AS n"),
        *[F.expr(f"{f}({c}) AS {f}_{t}") for t, c in (("gross", "gross_amount"),
                                                     ("collected", "collected_amount"))
          for f in ("sum", "max")],
        F.expr("sum(commission_w_tax) AS commission"))


# NULL items are spread over the windows' tasks by session
NULL_SPREAD = "CASE WHEN item_id IS NULL THEN session_id END"
# from this size of its files on, a history's lines are counted by item
COUNTED_BYTES = 32 * 1024 * 1024
# more lines of an item than this are summed before they are dealt
HOT_LINES = 1_000_000
# of more hot bins than this no list is made: all lines are summed first
MOST_HOT_BINS = 10_000


def has_hot_item(base: DataFrame) -> str:
    """The SQL condition of the lines whose item, or whose session if they are without one,
    may have more than ``HOT_LINES`` lines; empty if there are none. Counted are bins of a
    hash of them, so that a task sends a few counts however many items it reads; the bins
    grow with the history."""
    bins = max(1 << 16, input_bytes(base) // HOT_LINES)

    def bin_of(key: str) -> str:
        return f"pmod(xxhash64({key}), {bins})"

    def crowded(lines: DataFrame, key: str) -> list:
        counts = lines.groupBy(F.expr(key).alias("bin")).count()
        return [r.bin for r in counts.where(F.col("count") > HOT_LINES).select("bin")
                .limit(MOST_HOT_BINS + 1).collect()]

    # the lines without an item are one bin first: their sessions are counted if it is crowded
    found = {"item_id": crowded(
        base, f"CASE WHEN item_id IS NOT NULL THEN {bin_of('item_id')} END")}
    if None in found["item_id"]:
        found["item_id"].remove(None)
        found["session_id"] = crowded(base.where("item_id IS NULL"), bin_of("session_id"))
    if any(len(hot) > MOST_HOT_BINS for hot in found.values()):
        return "true"
    return " OR ".join(
        f"(item_id IS {'NOT NULL' if key == 'item_id' else 'NULL'} AND "
        f"{bin_of(key)} IN ({', '.join(map(str, hot))}))" for key, hot in found.items() if hot)


def dealt_lines(base: DataFrame, hot: str = "") -> DataFrame:
    """The lines as :func:`item_status_rows` of one line each, dealt by item; those that
    meet the condition ``hot`` are summed before. A row of one line is sent with each
    amount once, as the maximum that it is."""
    cool = base.where(f"NOT ({hot})") if hot else base
    rows = cool.selectExpr(
        *SETTLEMENT_KEYS, "item_id", "item_status", "1 AS n", "gross_amount AS max_gross",
        "collected_amount AS max_collected", "commission_w_tax AS commission")
    if hot:
        rows = rows.unionByName(item_status_rows(base.where(hot)), allowMissingColumns=True)
    total = "coalesce(sum_{0}, max_{0}) AS sum_{0}" if hot else "max_{0} AS sum_{0}"
    return rows.repartition("item_id", F.expr(NULL_SPREAD)).selectExpr(
        *SETTLEMENT_KEYS, "item_id", "item_status", "n", "commission",
        *[c for t in ("gross", "collected") for c in (f"max_{t}", total.format(t))])


def _met(rows: DataFrame, *more: str) -> DataFrame:
    """:func:`item_status_rows` with the item's reversal amounts and the count and sums
    of the (item, status). ``more`` keys are the same in all rows of an item."""
    item = ", ".join([*more, "item_id", NULL_SPREAD])
    return rows.selectExpr(
        *more, *SETTLEMENT_KEYS, "item_id", "item_status", "n", "commission",
        *[f"coalesce(-max(max_{t}) OVER (PARTITION BY {item}), 0) AS back_{t}"
          for t in ("gross", "collected")],
        f"CAST(sum(n) OVER (PARTITION BY {item}, item_status) AS INT) AS all_n",
        *[f"sum(sum_{t}) OVER (PARTITION BY {item}, item_status) AS all_{t}"
          for t in ("gross", "collected")])


def _settlement_measures() -> dict[str, tuple[str, str]]:
    """measure -> (term of a row of :func:`_met`, type of the terms' sum)."""
    canceled = f"item_status = {sql.lit(S.STATUS_CANCELED)}"
    met = "item_id IS NOT NULL AND item_status IS NOT NULL"
    out = {}
    for t in ("gross", "collected"):
        whole = (f"CASE WHEN {canceled} THEN CAST(all_n * back_{t} AS {AMOUNT_SUM}) "
                 f"ELSE CAST(all_{t} AS {AMOUNT_SUM}) END")
        out[f"{t}_revenue"] = f"CASE WHEN {met} THEN n * {whole} END", AMOUNT_SUM
    times = f"CASE WHEN {met} THEN all_n ELSE 1 END"
    for status, name in ((S.STATUS_VALIDATED, "executed"), (S.STATUS_CANCELED, "cancelled"),
                         (S.STATUS_PURCHASED, "advance")):
        out[f"{name}_commission_w_tax"] = (
            f"CASE WHEN item_status = {sql.lit(status)} THEN {times} * commission ELSE 0 END",
            TAXED_AMOUNT_SUM)
    return out


SETTLEMENT_MEASURES = _settlement_measures()


def settlement_lines(base: DataFrame, counted: bool = True) -> DataFrame:
    """A12: settlement group -> gross, collected, executed / cancelled / advance
    commission with tax, with the (item, status) self-join multiplicities.

    A line with an item and a status meets all N lines of its (item, status): it
    counts N times and brings their consolidated sum, which for canceled lines is N
    reversals of the item. So n such lines of a settlement group bring n times that
    sum and N times their commission. A line without item or status meets nothing:
    it counts once and brings no amount.

    With ``counted`` a history of ``COUNTED_BYTES`` or more is counted by item here, and
    only the lines of hot items are summed before they are sent; else all are."""
    if counted and input_bytes(base) >= COUNTED_BYTES:
        rows = dealt_lines(base, has_hot_item(base))
    else:
        rows = item_status_rows(base)
    return _met(rows).groupBy(*SETTLEMENT_KEYS).agg(*[
        sql.col(sql.sum_as(term, kind), m) for m, (term, kind) in SETTLEMENT_MEASURES.items()])


def settlement_terms(rows: DataFrame, *more: str) -> DataFrame:
    """The terms of :func:`settlement_lines` row by row, from :func:`item_status_rows`
    that hold whole items, in a form that can be added up: a measure without a term is 0,
    ``{measure}_terms`` counts the terms that have a value, ``lines`` the lines. ``more``
    keys are the same in all rows of an item."""
    return _met(rows, *more).select(
        *more, *SETTLEMENT_KEYS, "item_id", "item_status",
        sql.col("CAST(n AS BIGINT)", "lines"), *[
            c for m, (term, kind) in SETTLEMENT_MEASURES.items() for c in (
                sql.col(f"CAST(coalesce({term}, 0) AS {kind})", m),
                sql.col(f"CAST(CASE WHEN ({term}) IS NOT NULL THEN 1 ELSE 0 END AS BIGINT)",
                        f"{m}_terms"))])


def canceled_reversals(base: DataFrame) -> DataFrame:
    """partner -> sum of the reversal amounts of its canceled lines (``v``).

    One aggregation per (partner, item) gives the largest collected amount and the
    number of canceled lines; a window over those rows gives the item's maximum. A
    NULL item finds no history and is spread by partner."""
    canceled = f"item_status = {sql.lit(S.STATUS_CANCELED)}"
    per_item = base.groupBy("partner_id", "item_id").agg(
        F.expr("max(collected_amount) AS most"),
        F.expr(f"CAST(count(CASE WHEN {canceled} THEN 1 END) AS INT) AS c"))
    item = "item_id, CASE WHEN item_id IS NULL THEN partner_id END"
    back = per_item.selectExpr(
        "partner_id", "c", f"CASE WHEN item_id IS NOT NULL THEN coalesce("
                           f"-max(most) OVER (PARTITION BY {item}), 0) END AS back")
    return (back.where("c > 0").groupBy("partner_id")
            .agg(sql.col(sql.sum_as("c * back", AMOUNT_SUM), "v")))


def partner_revenue(own: DataFrame, reversals: DataFrame) -> DataFrame:
    """A10: partner -> collected revenue of every line that is not ``purchased``
    (NULL status counts 0), canceled lines at their item's reversal amount, from
    the partners' ``own`` revenue (:func:`commission.partner_totals`; NULL for a
    partner with canceled lines only) and their :func:`canceled_reversals`."""
    return (own.selectExpr("partner_id", "own AS v").unionByName(reversals)
            .groupBy("partner_id")
            .agg(sum_as("v", AMOUNT_SUM).alias("revenue_collected")))
