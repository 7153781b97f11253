"""The whole analysis, from raw records to names, coordinates and a hierarchy."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from talkatlas.operators import cluster, facets, hierarchy, naming, neighbors, prepare, project
from talkatlas.operators.complete import Completer
from talkatlas.operators.embed import Encoder, embed
from talkatlas.params import HierarchyParams, NamingParams, ProjectionParams
from talkatlas.runtime import scratch
from talkatlas.sources.tables import (
    write_audit_texts,
    write_cluster_names,
    write_csv,
    write_hierarchy,
    write_table,
)


def analyse(
    raw: DataFrame,
    out_dir: str,
    completer_factory: Callable[[], Completer],
    encoder_factory: Callable[[], Encoder],
    naming_completer_factory: Callable[[], Completer] | None = None,
    k: int | None = None,
    naming_params: NamingParams | None = None,
    hierarchy_params: HierarchyParams | None = None,
    projection_params: ProjectionParams | None = None,
    title_col: str | None = "title",
    max_tasks: int | None = None,
    calls_in_flight: int = 1,
) -> DataFrame:
    """Run all stages and return the named rows with their coordinates.

    Each stage that is costly or cannot be repeated is written below
    ``out_dir`` and read back, so no later step and no retry computes it again.
    Facet answers are logged as they come in: a run that failed can be started
    again with the same ``out_dir`` and asks only for the rest.
    ``out_dir`` has to be storage that all executors share.  Columns travel with
    the rows from stage to stage, so no join by id puts them back.  Tables that
    the stages store for themselves are deleted at the end.
    """
    with scratch(raw.sparkSession):
        return _stages(
            raw,
            out_dir,
            completer_factory,
            encoder_factory,
            naming_completer_factory or completer_factory,
            k,
            naming_params,
            hierarchy_params,
            projection_params or ProjectionParams(),
            title_col,
            max_tasks,
            calls_in_flight,
        )


def _stages(
    raw,
    out_dir,
    completer_factory,
    encoder_factory,
    naming_completer_factory,
    k,
    naming_params,
    hierarchy_params,
    projection_params,
    title_col,
    max_tasks,
    calls_in_flight,
) -> DataFrame:
    p = naming_params or NamingParams()
    documents = prepare.conversation_documents(raw, title_col)
    found = write_table(
        facets.extract_facets(
            documents, completer_factory, max_tasks, calls_in_flight, keep_error=True, log_path=f"{out_dir}/facet_answers"
        ),
        f"{out_dir}/facets",
    )
    found = found.drop("error")
    kept = [c for c in found.columns if c != "id"]
    vectors = write_table(
        embed(found, encoder_factory, p.text_col, keep=kept), f"{out_dir}/embeddings"
    )
    labelled, used_k = cluster.fit_kmeans(vectors, k, keep=(*kept, "embedding"))
    rows = write_table(labelled, f"{out_dir}/clustered")
    named = write_table(
        naming.name_clusters(
            rows,
            naming_completer_factory,
            p,
            max_tasks=max_tasks,
            calls_in_flight=calls_in_flight,
        ),
        f"{out_dir}/cluster_names",
    )
    write_cluster_names(named, f"{out_dir}/cluster_names_csv", f"{out_dir}/cluster_names_jsonl")
    write_audit_texts(named, f"{out_dir}/naming_texts")
    write_hierarchy(hierarchy.build_hierarchy(rows, hierarchy_params), f"{out_dir}/hierarchy")
    near = neighbors.nearest_neighbors(rows, projection_params.n_neighbors, projection_params.metric)
    write_table(near, f"{out_dir}/neighbors")
    projected = project.project_and_merge(rows, projection_params).drop("embedding")
    finished = write_table(naming.attach_names(projected, named, bound=used_k), f"{out_dir}/named_rows")
    write_csv(finished, f"{out_dir}/named_rows_csv")
    return finished
