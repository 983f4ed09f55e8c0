from sluice.streaming.deliveries import (
    deliver, delivery_counts, first_deliveries, publish_model, score_newest, scored_leads,
)
from sluice.streaming.score import lead_stream, score_stream

__all__ = ["deliver", "delivery_counts", "first_deliveries", "lead_stream", "publish_model",
           "score_newest", "score_stream", "scored_leads"]
