"""Composed jobs: the analysis report, the regression model and the text jobs,
plus the catalog of registered queries."""

from sigflow.plans.analysis import hourly_indicator, hourly_report
from sigflow.plans.modeling import ModelFrame, fit_on_split, ml_frame, model_coefficients, predict_day
from sigflow.plans.venues import venue_requests, venue_results

__all__ = [
    "ModelFrame", "fit_on_split", "hourly_indicator", "hourly_report", "ml_frame", "model_coefficients",
    "predict_day", "venue_requests", "venue_results",
]
