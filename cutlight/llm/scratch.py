"""Where the operators cut lineage: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from cutlight.session import cut, shared_dir


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: executors may be lost, the lineage starts anew here."""
    return cut(df, name)


def free(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once a session: tasks import it wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_cutlight_sent", False):
        return
    package = Path(__file__).resolve().parent.parent
    path = str(Path(tempfile.mkdtemp(prefix="cutlight-")).resolve() / "cutlight.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    sc.addPyFile(path)
    sc._cutlight_sent = True
