"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# settings that may be changed on a running session
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # the JVM does not compile methods above 8000 bytes of bytecode; the
    # operator-at-a-time path is faster than an interpreted giant method
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tuned(spark: SparkSession) -> SparkSession:
    """The session with the settings that suit long rule expressions."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("loanframe")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        # many short Python tasks: sockets of the network add 40 ms to each
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    return tuned(builder.getOrCreate())
