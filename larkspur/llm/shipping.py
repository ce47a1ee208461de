"""Objects of this package as broadcasts that workers can open without having it installed."""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import Broadcast, SparkContext, cloudpickle


def shipped(context: SparkContext, value: Any) -> Broadcast[bytes]:
    return context.broadcast(cloudpickle.dumps(value))


def opened(shared: Broadcast[bytes]) -> Any:
    return pickle.loads(shared.value)
