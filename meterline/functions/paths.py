"""Parts of a file path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import SERVICES


def path_segment(path: Column | str, position: int) -> Column:
    """Segment of a '/'-separated path; 1 is the first, -1 the last, null beyond the ends."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def file_name(path: Column | str) -> Column:
    return path_segment(path, -1)


def service_code_of_path(path: Column | str, root: str | None = None) -> Column:
    """Service code named anywhere in ``path`` below ``root``, otherwise null.

    Pass the lake's root so that its own name has no part in the decision.
    """
    below = F.substring_index(path, root.rstrip("/") + "/", -1) if root else path
    below = F.col(below) if isinstance(below, str) else below
    code = F.lit(None).cast("int")
    for service, number in SERVICES.items():
        code = F.when(below.contains(service), F.lit(number)).otherwise(code)
    return code
