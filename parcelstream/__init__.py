"""parcelstream: logistics change-stream analytics on Spark.

Captured database change logs (Debezium-style JSON envelopes) are cleaned,
routed by a live configuration table into dimension tables, turned into
order/cargo transaction facts by a per-order state machine, enriched with
dimension lookups and rolled up per local day.  Every transformation is a
plain ``DataFrame -> DataFrame`` function usable in batch and in Structured
Streaming.
"""

from parcelstream.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
