"""Change feeds: current rows and history, from changes that arrive in any order, more than once, and with deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata.operators.order import with_neighbour
from jobstrata.operators.select import keep_latest, per_key


def _gone(deleted: str | None) -> Column:
    return F.coalesce(F.expr(deleted), F.lit(False)) if deleted else F.lit(False)


def current_rows(changes: DataFrame, keys: list[str], sequence: str, tiebreak: list[str], deleted: str | None = None) -> DataFrame:
    """The newest change of each key by ``sequence``, unless it is a delete (``deleted`` is a SQL condition).

    Order of arrival does not count: an older change that comes after a delete does not bring its row back.
    """
    return keep_latest(changes, keys, sequence, tiebreak).filter(~_gone(deleted))


def change_history(
    changes: DataFrame, keys: list[str], sequence: str, tiebreak: list[str], deleted: str | None = None, tracked: list[str] | None = None
) -> DataFrame:
    """All states of each key with ``valid_from`` and ``valid_to`` (NULL while a state lasts).

    A state ends where the next one, or a delete, begins; a delete is no state. Of changes with equal key and
    sequence the greatest by ``tiebreak`` counts, so a change that is delivered again adds nothing. With ``tracked``, a change
    that alters none of these columns continues the state before it. Changes without a sequence have no place in time and
    are left out.
    """
    known = changes.filter(F.col(sequence).isNotNull())
    rows = per_key(known, [*keys, sequence], [F.desc_nulls_last(c) for c in tiebreak], 1).withColumn("_gone", _gone(deleted))
    if tracked:
        state = F.when(~F.col("_gone"), F.struct(*tracked))
        rows = with_neighbour(rows.withColumn("_state", state).withColumn("_is", F.lit(True)), keys, [sequence], ["_is", "_gone", "_state"], "_before", after=False)
        same = F.col("_before_is") & (F.col("_before_gone") == F.col("_gone")) & F.col("_before_state").eqNullSafe(F.col("_state"))
        rows = rows.filter(~F.coalesce(same, F.lit(False))).drop("_state", "_is", "_before_is", "_before_gone", "_before_state")
    rows = with_neighbour(rows, keys, [sequence], [sequence], "_until_")
    spans = rows.withColumn("valid_from", F.col(sequence)).withColumn("valid_to", F.col(f"_until_{sequence}"))
    return spans.filter(~F.col("_gone")).select(*changes.columns, "valid_from", "valid_to")
