"""The stages of the analysis, one module per step."""
