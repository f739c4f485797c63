"""flexframe: drifting, nested, error-tolerant tables on Spark DataFrames."""

from .context import FlexContext
from .frame import Frame, FrameSet, ResolveOption
from .session import ensure_checkpoint_dir, local_session, scratch_dir

__all__ = ["FlexContext", "Frame", "FrameSet", "ResolveOption", "local_session", "scratch_dir", "ensure_checkpoint_dir"]
