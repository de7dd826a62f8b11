from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions import money, people, text, times
from tidemart.functions.records import as_messages, parse_records, split_readable, unreadable_records


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_rounding_takes_ties_up_also_below_zero(spark):
    assert one(spark, money.round_half_up(F.lit(0.125))) == 0.13
    assert one(spark, money.round_half_up(F.lit(-0.125))) == -0.12
    assert one(spark, money.round_half_up(F.lit(2.0))) == 2.0


def test_share_of_an_order_that_lists_nothing_is_zero(spark):
    zero = F.lit(0).cast("long")
    assert one(spark, money.share_cents(F.lit(500), zero, zero)) == 0


def test_age_groups_at_their_borders(spark):
    def group(days):
        day = F.lit("2022-01-01").cast("date")
        return one(spark, people.age_group(F.date_sub(day, days), day))
    assert group(20 * 365 - 1) == "lt20"
    assert group(20 * 365) == "20_30"
    assert group(31 * 365 - 1) == "20_30"
    assert group(31 * 365) == "gt30"
    assert one(spark, people.age_group(F.lit(None).cast("date"), F.current_date())) is None


def test_gender_of_missing_code(spark):
    assert one(spark, people.gender_name(F.lit("M"))) == "male"
    assert one(spark, people.gender_name(F.lit("F"))) == "female"
    assert one(spark, people.gender_name(F.lit(None).cast("string"))) == "female"


def test_day_and_hour_keys(spark):
    late = F.lit(1704067199999).cast("long")
    assert (one(spark, times.day_of_millis(late)), one(spark, times.hour_of_millis(late))) == ("2023-12-31", "23")
    midnight = F.lit(1704067200000).cast("long")
    assert (one(spark, times.day_of_millis(midnight)), one(spark, times.hour_of_millis(midnight))) == ("2024-01-01", "00")
    moment = F.lit("2022-10-27 04:30:20")
    assert (one(spark, times.day_of_text(moment)), one(spark, times.hour_of_text(moment))) == ("2022-10-27", "04")
    assert one(spark, times.hour_of_text(F.lit("2022-10-27"))) is None
    assert times.day_before("2024-03-01") == "2024-02-29"


def test_words_match_whole_and_in_any_case(spark):
    assert one(spark, text.matches_any_word(F.lit("Der Über-Blick"), "über"))
    assert not one(spark, text.matches_any_word(F.lit("Überblick"), "über"))
    assert one(spark, text.matches_any_word(F.lit("a+b c"), "c x"))
    assert one(spark, text.highlight(F.lit("The other the"), "the")) == "<em>The</em> other <em>the</em>"


def test_unreadable_messages_are_set_apart(spark, rows):
    df = spark.createDataFrame([('{"id": 1, "user_id": 5}',), ("{broken",), ("",), (None,), ('{"id": "x"}',)],
                               "value string")
    good = parse_records(df, schemas.ORDER_INFO)
    assert rows(good, "id", "user_id", "province_id") == [(1, 5, None)]
    assert unreadable_records(df, schemas.ORDER_INFO).count() == 4


def test_messages_carry_key_and_all_fields(spark):
    df = spark.createDataFrame([(7, "a")], "id long, name string")
    m = as_messages(df, key="id").first()
    assert (m["key"], m["value"]) == ("7", '{"id":7,"name":"a"}')


def test_numbers_sent_as_text(spark, rows):
    df = spark.createDataFrame([('{"id":"7","user_id":"3","final_total_amount":"12.30"}',), ('{"id":8,"user_id":3}',),
                                ('{"id":"seven"}',), ('{"id":',)], "value string")
    good = parse_records(df, schemas.ORDER_INFO)
    assert rows(good, "id", "user_id", "final_total_amount") == [(7, 3, 12.3), (8, 3, None)]
    assert rows(unreadable_records(df, schemas.ORDER_INFO)) == [('{"id":"seven"}',), ('{"id":',)]


def test_numbers_are_read_as_numbers_and_odd_ones_by_their_text(spark, rows, capsys):
    sent = ['{"id":1,"final_total_amount":1.50,"order_status":"O"}', '{"id":"2","final_total_amount":"NaN"}',
            '{"id":3,"final_total_amount":NaN}', '{"id":4,"final_total_amount":1e999}', '{"id":5.5}', '{"id":"6","id":7}',
            '{"id":99999999999999999999}', '{"id":true}', '{"id":""}', '{"id":8,"order_status":9}', '[{"id":10}]', "null"]
    df = spark.createDataFrame([(v,) for v in sent], "value string")
    good = parse_records(df, schemas.ORDER_INFO)
    assert rows(good.selectExpr("id", "string(final_total_amount)", "order_status")) == [
        (1, "1.5", "O"), (2, "NaN", None), (7, None, None), (8, None, "9")]
    left = {r[0] for r in unreadable_records(df, schemas.ORDER_INFO).collect()}
    assert left == {sent[i] for i in (2, 3, 4, 6, 7, 8, 10, 11)}
    out = split_readable(df, schemas.ORDER_INFO)[1]
    assert {sent[i] for i in (2, 4, 6, 7, 8)} <= {r["value"] for r in out.where("reason = 'number'").collect()}
    good.explain()
    assert "StructField(id,LongType" in capsys.readouterr().out


def test_words_of_scripts_without_spaces(spark):
    def found(title, query):
        return one(spark, text.matches_any_word(F.lit(title), query))
    assert found("红海行动2018", "红海") and found("看红海行动", "行动")
    assert found("红海abc行动", "abc") and found("カメラ用red", "red")
    assert not found("redder", "red") and not found("incident", "红")
