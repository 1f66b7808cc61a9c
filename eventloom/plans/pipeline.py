"""Staged runs: preprocess, discover, discretize, encode, recommend.

Each stage writes versions of its Parquet tables under the output folder and publishes
them together when it is done (see :mod:`eventloom.plans.versions`); later stages read
what is published. A skipped stage is reused as it is; a resumed run repeats
the stages whose options or inputs have changed, or that did not finish.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.encode import encode
from eventloom.operators.policy import finite_horizon_policy
from eventloom.operators.transform import discretize_table
from eventloom.plans.discovery import discover
from eventloom.plans.preprocess import preprocess
from eventloom.plans.versions import Versions
from eventloom.spec import LogSpec
from eventloom.staging import clear_staged

STAGES = ("preprocess", "discovery", "discretize", "encoding", "policy")


class Run:
    """One output folder."""

    def __init__(self, spark: SparkSession, spec: LogSpec, outdir: str):
        self.spark, self.spec, self.outdir = spark, spec, outdir.rstrip("/")
        self.versions = Versions(spark, self.outdir)

    def path(self, table: str) -> str:
        """The folder of the published version of a table."""
        return f"{self.outdir}/{self.versions.version_of(table, STAGES)}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def write(self, df: DataFrame, table: str) -> DataFrame:
        return self.versions.write(df, table)

    def made(self, stage: str, inputs: Sequence[str], work: Callable[[], object], resume: bool = False, source: str | None = None, **options: object) -> bool:
        """Do the ``work`` of a stage and publish its tables; False if a resumed run finds that it is still valid.

        ``inputs`` are the tables of earlier stages that it reads, ``source`` is the
        digest of what it reads from elsewhere.
        """
        read = {t: self.versions.version_of(t, STAGES) for t in inputs}
        if source is not None:
            read["source"] = source
        options = {"spec": self.spec, **options}
        if resume and self.versions.valid(stage, options, read):
            return False
        self.versions.begin()
        work()
        self.versions.finish(stage, options, read)
        self.versions.begin()
        return True

    def preprocess(self, raw: DataFrame) -> DataFrame:
        return self.write(preprocess(raw, self.spec), "log")

    def discovery(
        self,
        kind: str = "partial_k_means",
        k: int = 10,
        attributes: Sequence[str] | None = None,
        control_flow: Sequence[str] = (),
        bucket_of: Column | None = None,
        encoding: Mapping[str, str] | None = None,
    ) -> None:
        log = self.read("log")
        model = discover(log, self.spec, attributes, kind, k, control_flow, bucket_of, encoding=encoding)
        self.write(model.contract(), "mdp/transitions")
        self.write(model.actions, "mdp/actions")
        spec = self.spec
        skip = {spec.activity}
        categorical = [n for n in spec.categorical if n in log.columns and n not in skip]
        numeric = [n for n in dict.fromkeys((*spec.numeric, *spec.outcome_columns)) if n in log.columns]
        self.write(model.describe(categorical, numeric), "mdp/states_described")
        self.write(model.simplicity(), "mdp/simplicity")

    def discretize(self, bins: int = 3, exclude: Iterable[str] = ()) -> None:
        spec = self.spec
        table = discretize_table(
            self.read("mdp/states_described"),
            spec.drop_before_discretize,
            spec.sentinels,
            spec.keep_as_category,
            {"state", *exclude},
            bins,
        )
        self.write(table, "mdp/states_discretized")

    def encoding(self, initial: int | None = None, bonus: float = 10.0, **options) -> None:
        tables = encode(
            self.read("mdp/states_discretized"),
            self.read("mdp/transitions"),
            initial,
            bonus,
            self.spec.end_action,
            **options,
        )
        for name, table in tables.items():
            self.write(table, f"encoding/{name}")

    def policy(self, horizon: int = 20, discount: float = 1.0) -> DataFrame:
        table = finite_horizon_policy(self.read("mdp/transitions"), self.read("encoding/rewards"), horizon, discount)
        return self.write(table, "policy")


def run_all(
    spark: SparkSession,
    spec: LogSpec,
    outdir: str,
    raw: DataFrame | None = None,
    skip: Iterable[str] = (),
    kind: str = "partial_k_means",
    k: int = 10,
    initial: int | None = None,
    horizon: int = 20,
    discount: float = 1.0,
    bins: int = 3,
    bonus: float = 10.0,
    attributes: Sequence[str] | None = None,
    control_flow: Sequence[str] = (),
    bucket_column: str | None = None,
    exclude: Iterable[str] = (),
    encoding: Mapping[str, str] | None = None,
    clear: bool = False,
    resume: bool = False,
    source: str | None = None,
    **encode_options,
) -> DataFrame:
    """All stages but the skipped ones; returns the policy.

    With ``resume`` a stage that finished with the same options and inputs is not
    done again. The raw log is known by ``source``, any text that changes with it; by default by the
    files that ``raw`` is read from, with their sizes and times.

    ``bucket_column`` is the state attribute of the kind ``bucket``; ``exclude``
    names columns that are not discretized; ``encoding`` is the role of each
    category in k-means; ``encode_options`` go to
    :func:`eventloom.operators.encode.encode`. With ``clear`` all staged tables
    of the session are deleted at the end.
    """
    skip = set(skip)
    unknown = skip - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")
    run = Run(spark, spec, outdir)
    if "preprocess" not in skip:
        if raw is None:
            raise ValueError("a raw log is needed unless preprocess is skipped")
        run.made("preprocess", [], lambda: run.preprocess(raw), resume, source or run.versions.input_digest(raw))
    if "discovery" not in skip:
        bucket_of = F.col("state_key")[bucket_column] if bucket_column else None
        options = {"kind": kind, "k": k, "attributes": attributes, "control_flow": control_flow, "bucket": bucket_column, "encoding": encoding}
        run.made("discovery", ["log"], lambda: run.discovery(kind, k, attributes, control_flow, bucket_of, encoding), resume, **options)
    if "discretize" not in skip:
        run.made("discretize", ["mdp/states_described"], lambda: run.discretize(bins, exclude), resume, bins=bins, exclude=sorted(exclude))
    if "encoding" not in skip:
        read = ["mdp/states_discretized", "mdp/transitions"]
        run.made("encoding", read, lambda: run.encoding(initial, bonus, **encode_options), resume, initial=initial, bonus=bonus, **encode_options)
    if "policy" not in skip:
        read = ["mdp/transitions", "encoding/rewards"]
        run.made("policy", read, lambda: run.policy(horizon, discount), resume, horizon=horizon, discount=discount)
    if clear:
        clear_staged(spark)
    return run.read("policy")
