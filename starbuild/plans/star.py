"""End-to-end star build: staging -> dimensions -> fact -> checks -> Parquet.

``build_star`` is lazy and returns ``{name: DataFrame}``.  ``write_star``
materialises it in an order that suits a large cluster:

1. the combination dimension is written first and read back, which cuts
   lineage (an executor lost later never recomputes it from staging) and
   pins its surrogate keys to one materialisation;
2. the fact is joined with that written table; Spark broadcasts it or not
   from its bytes, and combinations that hold a large share of the rows
   (known from the counts gathered with the combinations) are spread;
3. the fact is written (optionally partitioned by a low-cardinality
   column); the other dimensions are written concurrently with steps 1-3.

Checks (``run_checks``) are lazy one-row frames; they can be written next
to the tables or collected for a log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starbuild.operators import columns as colops
from starbuild.operators import dims, facts, joins, quality
from starbuild.operators.fingerprint import Fingerprint, content_check, content_fingerprint, fingerprint_metrics, observed_content
from starbuild.sources import readers, sinks

@dataclass
class StagingSpec:
    """How to clean the staging fact source."""
    int_columns: Sequence[str] = ()
    bigint_columns: Sequence[str] = ()
    epoch_day_columns: Sequence[str] = ()
    pattern_dates: Mapping[str, str] = field(default_factory=dict)
    timestamp_date_columns: Sequence[str] = ()
    required: Sequence[str] = ()


@dataclass
class StarSpec:
    """Names and columns of the star."""
    fact_name: str
    fact_key: str
    flags: Sequence[str]
    flag_dim_name: str
    flag_key: str
    date_columns: Sequence[str]
    date_dim_name: str
    fact_layout: Sequence[tuple[str, str, str | None]]
    entity_name: str | None = None
    entity_key: str | None = None
    entity_columns: Sequence[str] = ()
    entity_split: tuple[str, str, tuple[str, str]] | None = None
    entity_fk: str | None = None          # fact column referencing the entity key
    rollup_name: str | None = None
    rollup_key: str | None = None
    rollup_sums: Sequence[str] = ()
    rollup_mean: str | None = None
    rollup_weight: str | None = None
    keep_null_date: bool = True
    rank_partitions: int | None = None    # tasks that rank the combinations (default: shuffle partitions)


def stage(df: DataFrame, spec: StagingSpec) -> DataFrame:
    """Casts, date decoding and required-column filtering, as one lazy plan."""
    out = df
    if spec.int_columns:
        out = colops.cast_columns(out, spec.int_columns, "int")
    if spec.bigint_columns:
        out = colops.cast_columns(out, spec.bigint_columns, "bigint")
    if spec.epoch_day_columns:
        out = colops.decode_epoch_days(out, spec.epoch_day_columns)
    if spec.pattern_dates:
        out = colops.parse_pattern_dates(out, spec.pattern_dates)
    if spec.timestamp_date_columns:
        out = colops.timestamps_to_dates(out, spec.timestamp_date_columns)
    if spec.required:
        out = colops.drop_missing_required(out, spec.required)
    return out


def build_other_dimensions(staged: DataFrame, spec: StarSpec, entity_src: DataFrame | None = None,
                           rollup_src: DataFrame | None = None) -> dict[str, DataFrame]:
    """All dimensions but the flag combinations, as lazy frames."""
    tables = {
        spec.date_dim_name: dims.date_dimension(staged, spec.date_columns,
                                                keep_null=spec.keep_null_date),
    }
    if entity_src is not None and spec.entity_name:
        tables[spec.entity_name] = dims.entity_dimension(
            entity_src, spec.entity_key, spec.entity_columns, split=spec.entity_split)
    if rollup_src is not None and spec.rollup_name:
        tables[spec.rollup_name] = dims.group_rollup_dimension(
            rollup_src, spec.rollup_key, spec.rollup_sums, spec.rollup_mean, spec.rollup_weight)
    return tables


def build_star(staged: DataFrame, spec: StarSpec, entity_src: DataFrame | None = None,
               rollup_src: DataFrame | None = None) -> dict[str, DataFrame]:
    """All star tables as frames (the flag combinations are counted and ranked
    at once, the rest is lazy)."""
    combos, hot = counted_combinations(staged, spec.flags)
    flag_dim = dims.rank_combinations(combos, spec.flags, spec.flag_key, num_partitions=spec.rank_partitions)
    tables = {spec.flag_dim_name: flag_dim} | build_other_dimensions(staged, spec, entity_src, rollup_src)
    tables[spec.fact_name] = facts.build_fact(staged, flag_dim, spec.flags, spec.flag_key,
                                              spec.fact_layout, [spec.fact_key], hot)
    return tables


def counted_combinations(staged: DataFrame, flags: Sequence[str]) -> tuple[DataFrame, dict[int, int]]:
    """Flag combinations with their row counts (reliable checkpoint, one scan)
    and those that hold a large share of the rows (hash and rows)."""
    combos = dims.flag_combinations(staged, flags).checkpoint(eager=True)
    return combos, joins.hot_of_counts(combos, flags, "rows")


def fact_with_checked_dimension(staged: DataFrame, flags: Sequence[str], key: str,
                                layout: Sequence[tuple[str, str, str | None]] | None = None,
                                salt_by: Sequence[str] | None = None,
                                ) -> tuple[DataFrame, DataFrame]:
    """Fact with its flag-combination key, for callers that do not write the
    star: the dimension is checkpointed (reliably, to the shared
    ``spark.checkpoint.dir``), which pins its keys and cuts its lineage.
    ``salt_by`` names the fact key.  Returns ``(fact, dimension)``.
    """
    combos, hot = counted_combinations(staged, flags)
    dim = dims.rank_combinations(combos, flags, key).checkpoint(eager=True)
    if layout is None:
        fact = facts.attach_dimension_key(staged, dim, flags, key, salt_by=salt_by, hot=hot)
    else:
        fact = facts.build_fact(staged, dim, flags, key, layout, salt_by, hot)
    return fact, dim


@dataclass
class WrittenStar:
    """Paths and schemas of written tables; ``read`` gives a table back with
    the types it was written with."""
    paths: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, StructType] = field(default_factory=dict)
    partitions: dict[str, list[str]] = field(default_factory=dict)
    content: dict[str, Fingerprint] = field(default_factory=dict)   # of every table, as it was written
    staged_content: Fingerprint | None = None                       # of the fact's columns in the staging rows

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return sinks.read_parquet(spark, self.paths[name], self.schemas[name], self.partitions.get(name))


def write_star(spark: SparkSession, staged: DataFrame, spec: StarSpec, root: str,
               entity_src: DataFrame | None = None, rollup_src: DataFrame | None = None,
               fact_partition_by: Sequence[str] | None = None,
               compression: str = "gzip",
               metrics: dict[str, dict] | None = None,
               max_parallel_writes: int = 4, cluster: str = "none",
               max_records_per_file: int | None = None, known_flags: DataFrame | None = None,
               first_flag_key: int = 0, known_dates: DataFrame | None = None) -> WrittenStar:
    """Write the star under ``root`` (a shared folder or object-store URI).

    See the module docstring for the order, and ``sinks.write_parquet`` for
    ``cluster`` and ``max_records_per_file`` (both lay out the fact).
    If ``metrics`` is a dict, it receives ``{table: {"rows": n, ...}}``
    gathered during the writes themselves (``DataFrame.observe``), so no
    extra count job runs; for the fact, ``null_keys`` counts rows whose
    flag-combination key is NULL.  The same observations give every table's
    content fingerprint, and that of the fact's columns in the staging rows that
    the fact job reads (with range clustering, which runs its input twice, that
    one is a job of its own).

    ``known_flags`` is the flag dimension of an earlier load: its combinations
    keep their keys, new ones get those from ``first_flag_key`` on.
    ``known_dates`` (an earlier date dimension) stays part of the new one.
    """
    others = build_other_dimensions(staged, spec, entity_src, rollup_src)
    key_out = next((t for t, src, _ in spec.fact_layout if src == spec.flag_key), None)
    if known_dates is not None:
        dates = others[spec.date_dim_name]
        others[spec.date_dim_name] = dates.unionByName(known_dates.select(*dates.columns)).dropDuplicates()
    star, seen = WrittenStar(), {}

    def write(name: str, df: DataFrame, key: str | None = None, **layout) -> None:
        path = sinks.table_path(root, name)
        star.schemas[name], star.partitions[name] = df.schema, list(layout.get("partition_by") or [])
        keys = [F.count_if(F.col(f"`{key}`").isNull()).alias("null_keys")] if key is not None else []
        columns = [c for c in df.columns if name != spec.fact_name or c != key_out]
        obs = seen[name] = Observation(name)
        content = fingerprint_metrics([(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns])
        sinks.write_parquet(df, path, compression=compression, observe=lambda rows: rows.observe(obs, *content, *keys), **layout)
        star.paths[name] = path

    def write_flags_and_fact() -> None:
        combos, hot = counted_combinations(staged, spec.flags)
        write(spec.flag_dim_name, dims.extend_combinations(known_flags, combos, spec.flags, spec.flag_key, first_flag_key,
                                                           num_partitions=spec.rank_partitions))
        # the same columns before the join: what the fact must hold
        layout = [x for x in spec.fact_layout if x[1] != spec.flag_key]
        expected = colops.project(staged, layout)
        values = [(c, f.dataType) for c, f in zip(colops.layout_columns(staged, layout), expected.schema.fields, strict=True)]
        source, watched = observed_content(staged, "staged", values=values)
        sampled = cluster == "range" and fact_partition_by       # range bounds run the plan below them twice
        fact = facts.build_fact(staged if sampled else source, star.read(spark, spec.flag_dim_name), spec.flags,
                                spec.flag_key, spec.fact_layout, [spec.fact_key], hot)
        write(spec.fact_name, fact, key_out, partition_by=fact_partition_by, cluster=cluster,
              max_records_per_file=max_records_per_file)
        star.staged_content = content_fingerprint(expected) if sampled else Fingerprint.of(watched.get)

    # Independent writes run as concurrent jobs so their tasks share the
    # cluster; the fact follows the flag dimension.  A failed write re-raises.
    with ThreadPoolExecutor(max_workers=max(1, min(len(others) + 1, max_parallel_writes))) as pool:
        futures = [pool.submit(write_flags_and_fact), *(pool.submit(write, n, df) for n, df in others.items())]
        for f in futures:
            f.result()
    found = {name: dict(obs.get) for name, obs in seen.items()}
    star.content = {name: Fingerprint.of(m) for name, m in found.items()}
    if metrics is not None:
        metrics.update({name: {"rows": m["content_rows"]} | ({"null_keys": m["null_keys"]} if "null_keys" in m else {})
                        for name, m in found.items()})
    return star


def run_checks(staged: DataFrame, tables: Mapping[str, DataFrame], spec: StarSpec,
               entity_src: DataFrame | None = None,
               fact_id_unique: bool | None = False, approx: bool = False) -> dict[str, DataFrame]:
    """The two run-time checks of the original, as one-row frames: key
    reconciliation for the fact, the date dimension (per source date column)
    and the entity, and fact-to-entity join coverage.

    All keys of the staging source are counted in one scan of it (eagerly:
    a few rows, kept by a reliable checkpoint); the frames themselves are lazy
    and read the output tables only.  ``fact_id_unique`` (the fact's id, its
    first layout column, is known to be unique) lets the coverage check skip
    its ``(id, fk)`` de-duplication shuffle; None finds it out from the fact's
    reconciliation (one collected row, which is not computed again).
    ``approx`` estimates distinct keys in the reconciliations with
    HyperLogLog++ (no key shuffle); an estimate proves no uniqueness."""
    keys = [spec.fact_key, *(c for c in spec.date_columns if c != spec.fact_key)]
    counts = quality.key_counts(staged, keys, approx).checkpoint(eager=True)
    fact_check = quality.reconcile_counts(staged, spec.fact_key, tables[spec.fact_name],
                                          spec.fact_layout[0][0], approx, stage_counts=counts)
    if fact_id_unique is None:
        fact_id_unique = False
        if not approx:
            row = fact_check.first()
            fact_check = fact_check.sparkSession.createDataFrame([row], fact_check.schema)
            fact_id_unique = row["duplicates"] == 0 and row["output_unique"] == row["output_rows"]
    checks = {f"reconcile_{spec.fact_name}": fact_check}
    for c in spec.date_columns:
        checks[f"reconcile_{spec.date_dim_name}_{c}"] = quality.reconcile_counts(
            staged, c, tables[spec.date_dim_name], "datestamp", approx, stage_counts=counts)
    if spec.entity_name and spec.entity_name in tables and entity_src is not None:
        checks[f"reconcile_{spec.entity_name}"] = quality.reconcile_counts(
            entity_src, spec.entity_key, tables[spec.entity_name], spec.entity_key,
            approx=approx)
        if spec.entity_fk:
            # The id is named: a Parquet read-back moves partition columns
            # last, so "first column" would not be stable.
            checks[f"coverage_{spec.fact_name}_{spec.entity_name}"] = quality.join_coverage(
                tables[spec.fact_name], spec.entity_fk, tables[spec.entity_name],
                spec.entity_key, id_col=spec.fact_layout[0][0],
                distinct_pairs=not fact_id_unique)
    return checks


@dataclass
class StarRun:
    """What ``run_star`` produced: table paths, row counts observed during
    the writes, and the check frames (lazy, over the written tables)."""
    paths: dict[str, str]
    metrics: dict[str, dict]
    checks: dict[str, DataFrame]
    star: WrittenStar


def run_star(spark: SparkSession, staged: DataFrame, spec: StarSpec, root: str,
             entity_src: DataFrame | None = None, rollup_src: DataFrame | None = None,
             sample_fraction: float | None = None, seed: int = 42, checks: bool = True,
             fact_partition_by: Sequence[str] | None = None,
             compression: str = "gzip", write_checks: bool = False,
             approx_checks: bool = False, cluster: str = "none",
             max_records_per_file: int | None = None) -> StarRun:
    """The whole job: optional seeded sample of the staged source, star
    write, and (if ``checks``) the run-time checks.

    The sample is taken on the staged plan before anything is computed, by a
    hash of the fact key, so a 1 % run is the same however the source is
    split.  The checks are built on the written tables, not on the lazy fact,
    so they never recompute the join; ``write_checks`` stores their one-row
    results under ``root/_checks/<name>``.  The staging source is scanned for
    the flag combinations, the dates, the fact and the checks: four times,
    whatever the number of date columns.
    """
    if sample_fraction is not None:
        staged = readers.sample_rows(staged, sample_fraction, seed, [spec.fact_key])
    metrics: dict[str, dict] = {}
    star = write_star(spark, staged, spec, root, entity_src=entity_src, rollup_src=rollup_src,
                      fact_partition_by=fact_partition_by, compression=compression,
                      metrics=metrics, cluster=cluster, max_records_per_file=max_records_per_file)
    paths, found = dict(star.paths), {}
    if checks:
        tables = {name: star.read(spark, name) for name in star.paths}
        found = run_checks(staged, tables, spec, entity_src, fact_id_unique=None, approx=approx_checks)
        found[f"content_{spec.fact_name}"] = content_check(spark, star.staged_content, star.content[spec.fact_name])
        if write_checks:
            # One-row results: kept next to the tables as an audit record.
            for name, df in found.items():
                paths[f"_checks/{name}"] = sinks.write_parquet(
                    df.coalesce(1), sinks.table_path(sinks.table_path(root, "_checks"), name),
                    compression=compression)
    return StarRun(paths, metrics, found, star)
