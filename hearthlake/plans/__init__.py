"""The layer models and the pipeline that runs them in order."""
