"""Survey cohort analytics on Spark.

Every model is a plain function over DataFrames; nothing is collected to the
"""

from cohortlab.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
