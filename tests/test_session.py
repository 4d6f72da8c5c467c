import pytest

from tillroll.session import MOST_TASKS, TASK_BYTES, input_bytes, tune

SIZED = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"]


@pytest.fixture
def restored(spark):
    yield spark
    for key in SIZED:
        spark.conf.unset(key)


def test_input_bytes_lists_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x" * 100)
    (tmp_path / "b.csv").write_text("y" * 50)
    assert input_bytes(spark, str(tmp_path)) == 150


def test_small_inputs_change_no_sizes(restored):
    before = [restored.conf.get(key, None) for key in SIZED]
    tune(restored, 10 << 20)
    assert [restored.conf.get(key, None) for key in SIZED] == before


def test_a_small_input_after_a_large_one_sets_back(restored):
    restored.conf.set(SIZED[1], "12345678")
    before = [restored.conf.get(key, None) for key in SIZED]
    tune(restored, 1 << 40)
    assert [restored.conf.get(key, None) for key in SIZED] != before
    tune(restored, 1 << 41)
    tune(restored, 10 << 20)
    assert [restored.conf.get(key, None) for key in SIZED] == before


@pytest.mark.parametrize(
    ("size", "tasks", "split"),
    [(1 << 40, 4096, TASK_BYTES), (100 * 10**12, MOST_TASKS, 100 * 10**12 // MOST_TASKS)],
)
def test_large_inputs_get_more_then_larger_tasks(restored, size, tasks, split):
    tune(restored, size)
    assert [int(restored.conf.get(key)) for key in SIZED] == [tasks, split]
