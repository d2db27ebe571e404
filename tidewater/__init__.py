"""Commerce lakehouse analytics as plain Spark jobs."""

from tidewater.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
