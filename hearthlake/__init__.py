"""hearthlake: a listings lakehouse written as Spark DataFrame jobs.

Layers: pages -> snapshots -> bronze -> silver -> gold (four dimensions, one fact).
"""

from hearthlake.params import RunParams
from hearthlake.session import build_session, configure

__all__ = ["RunParams", "build_session", "configure"]
