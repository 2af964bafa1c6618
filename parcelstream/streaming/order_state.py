"""Per-order state for the change stream (``transformWithStateInPandas``).

Python only sequences each order's changes; decoding, masking and the fact
projection stay JVM-side (the processor passes row images through as JSON
text, typed again afterwards with the same ``fact_columns`` as the batch
job).

State per order key:

* ``info``   — the order waiting for cargo (image, event time, whether a
  cargo joined it); it expires ``window_ms`` after it was stored: an
  event-time timer clears it, and an order that no cargo joined (expired, or
  replaced by a newer waiting order) is emitted as ``expired_without_cargo``;
* ``detail`` — the latest cargo row; cleared after a sign or cancel.

Rules (per change, in ``(ts_ms, part, seq)`` order; ``part`` and ``seq`` are the
record's position, compared as they are, whatever their size):

* order ``c``: with a detail -> place-order fact (detail, order);
  without -> store the order;
* order ``u`` with a changed status: routed to its fact with the current
  detail (sign/cancel then clear the detail); no detail -> quarantine;
  no previous status -> quarantine;
* cargo ``c``: becomes the detail; a stored, unexpired order -> place-order
  fact (cargo, order).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from parcelstream import schemas
from parcelstream.operators import orders

OUTPUT_DDL = ("route string, part int, seq long, ts_ms long, order_key string, order_json string, "
              "cargo_json string")
INFO_DDL = "order_json string, at long, part int, seq long, joined boolean"
COLUMNS = [c.split()[0] for c in OUTPUT_DDL.split(", ")]
DETAIL_DDL = "cargo_json string"

ROUTES = {lab: fact for lab, (fact, _) in schemas.TRANSITION_FACTS.items()}
PLACE = schemas.PLACE_FACT[0]
CANCEL = schemas.CANCEL_FACT[0]
SIGN = orders.SIGN_FACT
NO_DETAIL, NO_BEFORE, EXPIRED = "no_detail", "no_before_status", "expired_without_cargo"


def route_of(before: str | None, status: str | None) -> str | None:
    """Python twin of :func:`orders.route_column` for one changed update."""
    if before is None or status is None or before == status:
        return None
    fact = ROUTES.get(f"{before} -> {status}")
    if fact is None and status == schemas.ST_CANCELLED:
        fact = CANCEL
    return fact


class OrderCargoProcessor(StatefulProcessor):
    """``processing_time=True`` measures the waiting window in arrival
    (processing) time, like the reference's state TTL; otherwise in event
    time (deterministic replays and the batch twin)."""

    def __init__(self, window_ms: int = 5000, processing_time: bool = False):
        self.window_ms = window_ms
        self.processing_time = processing_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.info = handle.getValueState("info", INFO_DDL)
        self.detail = handle.getValueState("detail", DETAIL_DDL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["ts_ms", "part", "seq"])
        info = self.info.get() if self.info.exists() else None
        info_json, info_at, info_part, info_seq, joined = (
            (info[0], int(info[1]), int(info[2]), int(info[3]), bool(info[4]))
            if info is not None else (None, None, None, None, False))
        detail = self.detail.get()[0] if self.detail.exists() else None
        okey = str(key[0])
        now = timerValues.getCurrentProcessingTimeInMs() if self.processing_time else None
        out = []

        def emit(route, r, order_json, cargo_json):
            out.append((route, int(r.part), int(r.seq), int(r.ts_ms), okey, order_json, cargo_json))

        for r in pdf.itertuples(index=False):
            if r.table == "order_info" and r.op == "c":
                if detail is not None:
                    emit(PLACE, r, r.order_json, detail)
                else:
                    if info_json is not None and not joined:
                        out.append((EXPIRED, info_part, info_seq, info_at, okey, info_json, None))
                    info_json, info_at, info_part, info_seq, joined = (
                        r.order_json, now if self.processing_time else int(r.ts_ms),
                        int(r.part), int(r.seq), False)
                    self.handle.registerTimer(info_at + self.window_ms)
            elif r.table == "order_info" and r.op == "u":
                if r.before_status is None or pd.isna(r.before_status):
                    emit(NO_BEFORE, r, r.order_json, None)
                    continue
                fact = route_of(r.before_status, r.status)
                if fact is None:
                    continue
                if detail is None:
                    emit(NO_DETAIL, r, r.order_json, None)
                else:
                    emit(fact, r, r.order_json, detail)
                if fact in (SIGN, CANCEL):
                    detail = None
            elif r.table == "order_cargo" and r.op == "c":
                detail = r.cargo_json
                at = now if self.processing_time else int(r.ts_ms)
                if info_json is not None and at < info_at + self.window_ms:
                    emit(PLACE, r, info_json, r.cargo_json)
                    joined = True

        if info_json is not None:
            self.info.update((info_json, info_at, info_part, info_seq, joined))
        if detail is not None:
            self.detail.update((detail,))
        elif self.detail.exists():
            self.detail.clear()
        yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        if self.info.exists():
            order_json, at, part, seq, joined = self.info.get()
            if int(at) + self.window_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.info.clear()
                if not joined:
                    out.append((EXPIRED, int(part), int(seq), int(at), str(key[0]), order_json, None))
        yield pd.DataFrame(out, columns=COLUMNS)

    def close(self) -> None:
        pass


def stream_input(log: DataFrame) -> DataFrame:
    """Shape a clean order change log (batch or stream) for the processor:
    row images travel as JSON text (typed decimals survive the round trip)."""
    part = F.col("part") if "part" in log.columns else F.lit(0)
    return log.select(
        F.col("order_key").cast("string").alias("order_key"), part.cast("int").alias("part"),
        "seq", "ts_ms", "op", "table",
        "status", "before_status",
        F.to_json("order_after").alias("order_json"),
        F.to_json("cargo_after").alias("cargo_json"),
        F.timestamp_millis("ts_ms").alias("event_time"))


def state_relevant() -> F.Column:
    """Rows the processor acts on.  An update with a previous status that routes
    to no fact emits nothing and touches no state, so it never reaches Python."""
    route = orders.route_column(F.col("op"), F.col("table"), F.col("before_status"),
                                F.col("status"))
    inert = ((F.col("table") == "order_info") & (F.col("op") == "u")
             & F.col("before_status").isNotNull() & route.isNull())
    return ~F.coalesce(inert, F.lit(False))


def apply_state(inp: DataFrame, window_ms: int = 5000, watermark: str | None = None,
                time_mode: str = "EventTime") -> DataFrame:
    """Run the processor keyed by order.

    ``EventTime``: the window is measured in event time and timers fire when
    the watermark passes ``stored time + window`` (deterministic).  Spark drops
    rows older than the watermark delay before the processor sees them and
    counts them in the query's progress (``numRowsDroppedByWatermark``), so the
    delay has no default: it must cover the stream's disorder.
    ``ProcessingTime``: the window is measured in arrival
    time like the reference's state TTL; no row is ever dropped as late."""
    if time_mode == "ProcessingTime":
        return inp.filter(state_relevant()).groupBy("order_key").transformWithStateInPandas(
            OrderCargoProcessor(window_ms, processing_time=True), OUTPUT_DDL, "append",
            "ProcessingTime")
    if watermark is None:
        raise ValueError("event time needs a watermark delay that covers the stream's disorder")
    return (inp.withWatermark("event_time", watermark).filter(state_relevant())
            .groupBy("order_key")
            .transformWithStateInPandas(OrderCargoProcessor(window_ms), OUTPUT_DDL, "append",
                                        "EventTime"))


def facts_from_output(out: DataFrame, fact: str) -> DataFrame:
    """Typed fact rows (same projection as the batch job)."""
    o = orders.mask_order(F.from_json("order_json", schemas.ORDER_INFO))
    c = F.from_json("cargo_json", schemas.ORDER_CARGO)
    time_from = "cargo" if fact == PLACE else "order"
    time_name = schemas.PLACE_FACT[1] if fact == PLACE else orders.FACT_TIME[fact]
    return out.filter(F.col("route") == fact).select(
        *orders.fact_columns(c, o, time_name, time_from))


NO_ORDER_ID = "no_order_id"


def _order_key() -> F.Column:
    from parcelstream.operators import ods
    return F.when(F.col("table") == "order_info", ods.vget(F.col("after"), "id")) \
        .otherwise(ods.vget(F.col("after"), "order_id"))


def order_log_rejects(ods_rows: DataFrame) -> DataFrame:
    """Order and cargo records without a key for the per-order state, for the
    quarantine: ``part, offset, reason, table, value`` (the row image)."""
    from parcelstream.operators import ods
    return ods.dwd_filter(ods_rows).filter(_order_key().isNull()).select(
        "part", "offset", F.lit(NO_ORDER_ID).alias("reason"), "table",
        F.to_json("after").alias("value"))


def order_log_from_ods(ods_rows: DataFrame) -> DataFrame:
    """Order/cargo change log from parsed ODS records (batch or stream):
    the order key is ``after.id`` for an order and ``after.order_id`` for a
    cargo row; ``(part, seq)`` is the record position.  Rows without that key
    are in :func:`order_log_rejects`."""
    from parcelstream.operators import ods
    d = ods.dwd_filter(ods_rows).filter(_order_key().isNotNull())
    is_order = F.col("table") == "order_info"
    order = ods.decode(F.col("after"), schemas.ORDER_INFO)
    cargo = ods.decode(F.col("after"), schemas.ORDER_CARGO)
    return d.select(
        _order_key().alias("order_key"), "part", F.col("offset").alias("seq"), F.col("ts").alias("ts_ms"), "op", "table",
        F.when(is_order, order.getField("status")).alias("status"),
        F.when(is_order, ods.vget(F.col("before"), "status")).alias("before_status"),
        F.when(is_order, order).alias("order_after"),
        F.when(~is_order, cargo).alias("cargo_after"))
