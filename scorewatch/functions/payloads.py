"""Values inside request log entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorewatch import constants as K


def response_score(response: Column) -> Column:
    """First score of a JSON response, NULL when the text holds none.

    Kept as DOUBLE: texts of the same number differ (1.0E-4, 0.0001), so scores are compared as
    numbers.
    """
    return F.get_json_object(response, K.SCORE_PATH).try_cast("double")


def metadata_value(metadata: Column, key: str) -> Column:
    """Value of a map entry, NULL when the key is absent."""
    return F.try_element_at(metadata, F.lit(key))
