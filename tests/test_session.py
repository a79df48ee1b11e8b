from seasonmart.session import SETTINGS, shuffle_partitions, tune


def test_partitions_are_bounded_in_size():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(128 << 20, 1) == 1
    assert shuffle_partitions((128 << 20) + 1, 1) == 2
    assert shuffle_partitions(10**13, 4000) == 74506


def test_tune_sets_a_running_session(spark):
    session = spark.newSession()
    tune(session, shuffled_bytes=10**10)
    assert {k: session.conf.get(k) for k in SETTINGS} == SETTINGS
    assert session.conf.get("spark.sql.shuffle.partitions") == "75"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
