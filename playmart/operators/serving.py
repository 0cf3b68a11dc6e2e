"""Query-first tables and the look-ups they exist for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.operators.dedupe import last_per_key
from playmart.schemas import SESSION_ITEMS, SONG_LISTENERS, USER_SESSION, ServingTable


def build_serving(plays: DataFrame, table: ServingTable, order: Sequence[str] = ()) -> DataFrame:
    """Rows of a serving table: unique on its key, the last write in `order` wins."""
    keys = table.primary_key
    rows = plays.select(*keys, *table.values, *[c for c in order if c not in keys + table.values])
    rows = rows.dropna(subset=list(keys))
    return last_per_key(rows, keys, order).select(*keys, *table.values)


def session_item(items: DataFrame, session_id: int, item_in_session: int) -> DataFrame:
    """What was heard as one item of one session. Expects the columns of SESSION_ITEMS."""
    hit = items.where((F.col("session_id") == session_id) & (F.col("item_in_session") == item_in_session))
    return hit.select(*SESSION_ITEMS.values)


def user_session(playlist: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """What one user heard in one session, in item order. Expects the columns of USER_SESSION."""
    hit = playlist.where((F.col("user_id") == user_id) & (F.col("session_id") == session_id))
    return hit.orderBy("item_in_session").select("item_in_session", *USER_SESSION.values)


def song_listeners(listeners: DataFrame, song: str) -> DataFrame:
    """Names of all users who heard a song; users who share a name appear once each."""
    return listeners.where(F.col("song") == song).select(*SONG_LISTENERS.values)


def sessions_items(playlist: DataFrame, session_id: int) -> DataFrame:
    """What anybody heard in one session: a later key column alone, for which the stored table has Bloom filters."""
    return playlist.where(F.col("session_id") == session_id).select("user_id", "item_in_session", *USER_SESSION.values)
