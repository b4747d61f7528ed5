"""layerflow: metadata-driven raw -> curated -> gold table processing on Spark.

Every step is a plain DataFrame function; only publishing (writes) and the
audit log run Spark actions.  See README.md for the module map.
"""

from layerflow.session import RunContext, build_session, scratch_dir, shared_root

__all__ = ["RunContext", "build_session", "scratch_dir", "shared_root"]
