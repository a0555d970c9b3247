"""Compositions of operators: the data-preparation flow, feature refresh,
model data and scoring, each as a function of sources and parameters."""
