"""Call-form transforms: ``ApplyMapping.apply(frame=..., mappings=...)`` etc.

A transform's call form is the frame method of the same operator, called with
the frame as first argument. ``_call_form`` makes the classes from the list
below; those with defaults or argument names of their own follow it.
"""

from __future__ import annotations

from ..frame import Frame, FrameSet


def _call_form(name: str, run):
    """A class whose ``apply``, and whose instances when called, run ``run``."""
    return type(name, (), {
        "__doc__": f"Call form of {name}.",
        "__call__": lambda self, *args, **kwargs: run(*args, **kwargs),
        "apply": staticmethod(run),
        "name": staticmethod(lambda: name),
    })


def _method(method: str, owner=Frame, first: str = "frame", renamed: dict[str, str] | None = None):
    """``owner.method`` with the owner under the keyword ``first`` and some keywords renamed."""
    def run(*args, **kwargs):
        if first in kwargs:
            args = (kwargs.pop(first), *args)
        kwargs = {(renamed or {}).get(k, k): v for k, v in kwargs.items()}
        return getattr(owner, method)(*args, **kwargs)

    return run


def _split(method: str, names):
    """A split whose outputs are named by ``names(frame)`` unless the caller names them."""
    def run(frame, what=None, name1=None, name2=None, **kwargs):
        what = kwargs.pop("paths", kwargs.pop("comparison_dict", what))
        first, second = names(frame)
        return getattr(frame, method)(what, name1 or first, name2 or second, **kwargs)

    return run


def _numbered(frame: Frame) -> tuple[str, str]:
    return tuple(f"{frame.name or 'frame'}{i}" for i in (1, 2))


def _join(frame1, frame2, keys1, keys2, **kwargs):
    return frame1.join(keys1, keys2, frame2, **kwargs)


def _relationalize(frame, staging_path=None, name="roottable", options=None, **kwargs):
    return frame.relationalize(name, staging_path, options, **kwargs)


def _every_frame(dfc, BaseTransform, frame_name="frame", transformation_ctx="", **fixed):
    """A transform over all frames of a collection."""
    return dfc.flatmap(
        lambda frame, ctx: BaseTransform.apply(transformation_ctx=ctx, **{**fixed, frame_name: frame}), transformation_ctx)


ApplyMapping = _call_form("ApplyMapping", _method("apply_mapping"))
SelectFields = _call_form("SelectFields", _method("select_fields"))
DropFields = _call_form("DropFields", _method("drop_fields"))
RenameField = _call_form("RenameField", _method("rename_field", renamed={"old_name": "oldName", "new_name": "newName"}))
SplitFields = _call_form("SplitFields", _split("split_fields", _numbered))
SplitRows = _call_form("SplitRows", _split("split_rows", lambda frame: ("frame1", "frame2")))
Join = _call_form("Join", _join)
Filter = _call_form("Filter", _method("filter"))
Map = _call_form("Map", _method("map"))
Unbox = _call_form("Unbox", _method("unbox"))
UnnestFrame = _call_form("UnnestFrame", _method("unnest"))
Relationalize = _call_form("Relationalize", _relationalize)
ResolveChoice = _call_form("ResolveChoice", _method("resolveChoice"))
DropNullFields = _call_form("DropNullFields", _method("drop_null_fields"))
Spigot = _call_form("Spigot", _method("spigot"))
Repartition = _call_form("Repartition", _method("repartition"))
Coalesce = _call_form("Coalesce", _method("coalesce"))
ErrorsAsFrame = _call_form("ErrorsAsFrame", _method("errorsAsFrame"))
SelectFromCollection = _call_form("SelectFromCollection", _method("select", FrameSet, "dfc"))
MapToCollection = _call_form("MapToCollection", _method("map", FrameSet, "dfc"))
FlatMap = _call_form("FlatMap", _every_frame)
