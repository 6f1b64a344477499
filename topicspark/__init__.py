"""topicspark: topic-partitioned question/answer text analytics on Spark.

Rows of (question, answer, topic) are validated and stored in one
topic-partitioned table, cut into chunks per topic, summarised into a chunk
index, searched by TF-IDF cosine and audited -- all as DataFrame plans.
"""

from topicspark.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
