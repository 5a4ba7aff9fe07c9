"""Store of fitted models; saving and loading derive the same path from the same facts."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def model_path(root: str, model: str, target: str, trained_on: str) -> str:
    return f"{root}/{model.replace(' ', '_')}_{target}_{trained_on}"


def save_model(fitted: PipelineModel, root: str, model: str, target: str, trained_on: str) -> str:
    path = model_path(root, model, target, trained_on)
    fitted.write().overwrite().save(path)
    return path


def load_model(root: str, model: str, target: str, trained_on: str) -> PipelineModel:
    """The fitted stages; the feature list is part of the first one."""
    return PipelineModel.load(model_path(root, model, target, trained_on))
