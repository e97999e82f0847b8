"""Consumer lag from the progress report of a streaming query."""

from __future__ import annotations

import json


def _offsets(value) -> dict:
    return json.loads(value) if isinstance(value, str) else (value or {})


def consumer_lag(progress: dict) -> int:
    """Messages that were in the topic but not yet read when the batch was planned.

    `progress` is one element of `StreamingQuery.recentProgress`, as a dict.
    """
    lag = 0
    for source in progress.get("sources", []):
        latest, read = _offsets(source.get("latestOffset")), _offsets(source.get("endOffset"))
        for topic, partitions in latest.items():
            if not isinstance(partitions, dict):  # a source other than a topic
                continue
            done = read.get(topic, {})
            lag += sum(max(0, end - done.get(partition, 0)) for partition, end in partitions.items())
    return lag
