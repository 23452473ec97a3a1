from tablewright import session


def test_local_sessions_without_the_setting_share_one_folder(spark, monkeypatch):
    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Bare:
        conf, sparkContext = Conf, spark.sparkContext

    one, two = session.work_folder(Bare, "a"), session.work_folder(Bare, "b")
    assert one != two and one.split("/tablewright/")[0] == two.split("/tablewright/")[0]


def test_set_folder_is_used(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert root is None or session.work_folder(spark, "x").startswith(root.rstrip("/"))
