"""What a stream still holds when it has been stopped, read from its checkpoint by Spark's state data source."""

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.checkpoints import checkpointed
from tidemark.streaming.queries import state_store


def operators(spark: SparkSession, run: str) -> list[Row]:
    """The stateful operators of a stream run by ``run_to_table`` in the folder ``run``: operatorId, operatorName, operatorProperties."""
    found = spark.read.format("state-metadata").load(f"{run}/checkpoint")
    # a row for each state store, of which an operator has a few
    return list(set(found.select("operatorId", "operatorName", "operatorProperties").collect()))


def state_variable(spark: SparkSession, run: str, variable: str, among: list[Row] | None = None) -> DataFrame | None:
    """A state variable of a stream; nothing if no operator of it (``among``: those to look at) has it."""
    for operator in operators(spark, run) if among is None else among:
        if f'"stateName":"{variable}"' in (operator.operatorProperties or ""):
            reader = spark.read.format("statestore").option("operatorId", operator.operatorId).option("stateVarName", variable)
            with state_store(spark):
                return reader.load(f"{run}/checkpoint")
    return None


def _state_of(spark: SparkSession, run: str, name: str) -> DataFrame | None:
    """The state of a stream's only operator of this kind."""
    found = [o for o in operators(spark, run) if o.operatorName == name]
    if len(found) > 1:
        raise ValueError(f"the stream has more than one operator {name}")
    if not found:
        return None
    return spark.read.format("statestore").option("operatorId", found[0].operatorId).load(f"{run}/checkpoint")


def open_groups(written: DataFrame, run: str) -> DataFrame:
    """The groups of an append-mode aggregate that its stream, run in the folder ``run``, has not written yet, with the columns of ``written``.

    The stream has to have one aggregate, its columns the keys and then aggregates that are kept as their value, which sums,
    counts, minima and maxima are. What the state has is read once and kept, since the next run changes it.
    """
    spark = written.sparkSession
    with state_store(spark):
        state = _state_of(spark, run, "stateStoreSave")
        if state is None:
            return written.where("false")
        fields = [F.col(f"{part}.`{f.name}`") for part in ("key", "value") for f in state.schema[part].dataType.fields]
        if len(fields) != len(written.columns):
            raise ValueError(f"the state has {len(fields)} columns, the result {len(written.columns)}")
        return checkpointed(state.select(*(f.cast(written.schema[c].dataType).alias(c) for f, c in zip(fields, written.columns))))


def open_gap_sessions(written: DataFrame, run: str) -> DataFrame:
    """The sessions that a stream of ``gap_sessions``, run in the folder ``run``, has not written yet, with the columns of ``written``."""
    spark = written.sparkSession
    with state_store(spark):
        state = _state_of(spark, run, "sessionWindowStateStoreSaveExec")
        if state is None:
            return written.where("false")
        key, last, n = (f"value.`{f.name}`" for f in state.schema["value"].dataType.fields[1:])
        fields = [key, "value.session_window.start", last, n]
        return checkpointed(state.select(*(F.col(f).alias(c) for f, c in zip(fields, written.columns))))
