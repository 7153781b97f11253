"""Settings of the stages, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass

DEFAULT_CRITERIA = (
    "Names describe the user's request as an imperative sentence of ten words or "
    "fewer, in the manner of 'Plan a weekend trip with small children'."
)


@dataclass(frozen=True)
class NamingParams:
    """How many examples stand for a cluster, and how they are drawn."""

    in_cluster_n: int = 50
    out_cluster_n: int = 50
    text_col: str = "request"
    cluster_col: str = "cluster_id"
    random_state: int = 42


@dataclass(frozen=True)
class HierarchyParams:
    """How clusters are put under parents; neither option set means one parent.

    ``linkage`` is how groups are merged, or ``divisive`` for a tree that is
    split from the top, for many thousands of clusters and ``n_parents`` only.
    """

    text_col: str = "request"
    cluster_col: str = "cluster_id"
    n_parents: int | None = None
    distance_threshold: float | None = None
    linkage: str = "average"
    random_state: int = 42

    def __post_init__(self) -> None:
        if self.linkage not in ("average", "single", "complete", "divisive"):
            raise ValueError(f"unknown linkage: {self.linkage}")
        if self.linkage == "divisive" and self.distance_threshold is not None:
            raise ValueError("a divisive tree takes n_parents, no distance_threshold")
        if self.n_parents is not None and self.distance_threshold is not None:
            raise ValueError("set n_parents or distance_threshold, not both")
        if self.n_parents is not None and self.n_parents < 1:
            raise ValueError("n_parents must be at least 1")


@dataclass(frozen=True)
class ProjectionParams:
    """Settings of the two-dimensional view and of the neighbour lists."""

    n_neighbors: int = 15
    min_dist: float = 0.1
    metric: str = "cosine"
    random_state: int = 42
    n_components: int = 2
    cache_key: str | None = None

    def __post_init__(self) -> None:
        if self.metric not in ("cosine", "euclidean"):
            raise ValueError(f"unknown metric: {self.metric}")
