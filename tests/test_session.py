"""Settings that bound what a task holds."""

from martloom.session import PARTITION_SETTINGS, bound_partitions


def test_partitions_are_bounded_unless_the_session_names_sizes(spark):
    other = spark.newSession()
    for key in PARTITION_SETTINGS:
        other.conf.unset(key)
    advisory, hashed = PARTITION_SETTINGS
    other.conf.set(hashed, "1m")
    bound_partitions(other)
    assert (other.conf.get(advisory), other.conf.get(hashed)) == ("16m", "1m")
