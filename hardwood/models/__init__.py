"""Regressors: MLlib fits, per-entity fits from aggregates, nearest neighbours."""
