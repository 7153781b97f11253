"""Schemas of the stored tables."""

from __future__ import annotations

RAW_CONVERSATIONS = (
    "id STRING, created_dttm STRING, title STRING, tags STRING, encoded_content STRING"
)
CONVERSATION_XML = "id STRING, conversation_xml STRING"
FACETS = "id STRING, request STRING, language STRING, task STRING, concerning STRING"
EMBEDDINGS = "id STRING, embedding ARRAY<FLOAT>"
CLUSTER_NAMES = "cluster_id INT, summary STRING, name STRING"
NAMED_ROWS = FACETS + ", cluster_id INT, summary STRING, name STRING"
HIERARCHY = (
    "meta STRUCT<n_clusters: BIGINT, n_parents: BIGINT, params: STRUCT<"
    "text_col: STRING, cluster_col: STRING, n_parents: INT, distance_threshold: DOUBLE, "
    "linkage: STRING, random_state: INT>>, "
    "parents ARRAY<STRUCT<parent_id: INT, child_cluster_ids: ARRAY<INT>, "
    "parent_summary: STRING, parent_name: STRING>>"
)
