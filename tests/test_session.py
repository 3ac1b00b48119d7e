import pytest

from tradewatch.session import RUNTIME_CONF, prepare, use_rocksdb_state, working_folder


class Settings:
    """Stands in for a session: the settings, the master and the application id."""

    def __init__(self, master, folder=None):
        self.folder, self.master, self.applicationId = folder, master, f"app-{master}"
        self.conf = self.sparkContext = self

    def get(self, name, default=None):
        return self.folder or default


def test_working_folder_lies_in_the_shared_folder():
    folder = working_folder(Settings("spark://host", "/shared/"), "silver")
    assert folder.startswith("/shared/silver-")
    assert folder != working_folder(Settings("spark://host", "/shared/"), "silver")


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        working_folder(Settings("spark://host"), "silver")


def test_local_session_falls_back_to_one_temporary_folder():
    one, two = (working_folder(Settings("local[2]"), name) for name in ("a", "b"))
    assert one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]


def test_prepare_sets_the_runtime_settings(spark):
    prepare(spark)
    assert {k: spark.conf.get(k) for k in RUNTIME_CONF} == RUNTIME_CONF


def test_stores_of_a_process_share_bounded_memory(spark):
    rocksdb = "spark.sql.streaming.stateStore.rocksdb."
    names = ("spark.sql.streaming.stateStore.providerClass", f"{rocksdb}changelogCheckpointing.enabled")
    bound = (f"{rocksdb}boundedMemoryUsage", f"{rocksdb}maxMemoryUsageMB")
    before = {name: spark.conf.get(name, None) for name in names + bound}
    try:
        use_rocksdb_state(spark)
        assert spark.conf.get(names[0]).endswith("RocksDBStateStoreProvider") and spark.conf.get(names[1]) == "true"
        assert spark.conf.get(bound[0]) == "true" and int(spark.conf.get(bound[1])) <= 500
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
