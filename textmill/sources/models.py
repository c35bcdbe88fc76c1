"""Saving and loading fitted models under dated folders."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable


def export_path(root: str, name: str, now: dt.datetime | None = None) -> str:
    """``root/export_YYYYmmdd_HHMMSS/name``; the root needs at least a container and a folder."""
    bare = root.split("://", 1)[-1].strip("/")
    if len(bare.split("/")) < 2:
        raise ValueError(f"invalid path: {root}")
    stamp = (now or dt.datetime.now()).strftime("export_%Y%m%d_%H%M%S")
    return f"{root.rstrip('/')}/{stamp}/{name}"


def save_model(model, root: str, name: str = "model", now: dt.datetime | None = None) -> str:
    """Save a pyspark.ml model or any model with a ``save(path)`` method; returns the path written."""
    path = export_path(root, name, now)
    if isinstance(model, MLWritable):
        model.write().save(path)
    else:
        model.save(path)
    return path


def load_model(path: str, loader=PipelineModel):
    """Load a saved model with the class that wrote it."""
    return loader.load(path)
