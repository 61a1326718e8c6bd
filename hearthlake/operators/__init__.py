"""DataFrame -> DataFrame steps shared by the layer models in ``hearthlake.plans``."""
