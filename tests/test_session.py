from docweave.session import get_spark


def test_settings_of_the_session_win(spark):
    zone, size = (spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.execution.arrow.maxRecordsPerBatch"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert get_spark() is spark
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "2000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
