"""flowframe: composable DataFrame operators for business-event pipelines."""

from flowframe.session import scratch_dir, session

__all__ = ["session", "scratch_dir"]
__version__ = "0.1.0"
