"""Outcome models on Spark ML: fitting, tuning, calibration, persistence."""

from offerwise.models.calibration import calibrate
from offerwise.models.fitting import (
    Learner,
    churn_risk,
    fit_churn_model,
    fit_outcome_model,
    model_features,
    save_model,
    scorer_of,
)
from offerwise.models.published import load_model, model_versions, publish, roll_back
from offerwise.models.tuning import SEARCH_SPACE, tune

__all__ = [
    "Learner",
    "SEARCH_SPACE",
    "calibrate",
    "churn_risk",
    "fit_churn_model",
    "fit_outcome_model",
    "load_model",
    "model_features",
    "model_versions",
    "publish",
    "roll_back",
    "save_model",
    "scorer_of",
    "tune",
]
