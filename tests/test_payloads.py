import json
import random

from pyspark.sql import functions as F

from fleetgrid.functions.payloads import CUSTOMER_TOPIC, TOPIC_FIELDS, TRIP_TOPIC, project_payload


def customers(spark, payloads):
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    return [tuple(r) for r in project_payload(df, CUSTOMER_TOPIC).collect()]


def test_values(spark):
    got = customers(
        spark,
        [
            '{"cust_id":"a","cust_latitude":1.50,"cust_longitude":true,"cust_datetime":""}',
            '{"CUST_ID":"a","cust_latitude":null}',
            '{"cust_id":"a"',
            '[{"cust_id":"a"}]',
            "",
            None,
        ],
    )
    assert got == [("a", "1.5", "true", ""), *[(None,) * 4] * 5]


def test_first_of_repeated_fields_counts(spark):
    got = customers(
        spark,
        [
            '{"cust_id":"first","cust_id":"second","cust_latitude":"1"}',
            '{"cust_id":null,"cust_id":"second"}',
            '{"other":1,"other":2,"cust_id":"x"}',
        ],
    )
    assert [g[0] for g in got] == ["first", "second", "x"]
    assert got[0][1] == "1"


def test_agrees_with_field_by_field_reading(spark):
    rng = random.Random(11)
    names = [*TOPIC_FIELDS[TRIP_TOPIC].values(), "x", "VENDORID", "lpep dropoff"]
    values = ["", "a", 'q"uo\\te', "tab\tnl\n", "ünï", 1, -1.50, 1e3, 12345678901234567890, True,
              None, [1, "2"], {"y": {"z": [None]}}, " lead"]

    def member():
        return f"{json.dumps(rng.choice(names))}: {json.dumps(rng.choice(values), ensure_ascii=rng.random() < 0.5)}"

    payloads = []
    for _ in range(3000):
        text = "{" + ", ".join(member() for _ in range(rng.randrange(7))) + "}"
        if rng.random() < 0.2:
            cut = rng.randrange(len(text))
            text = text[:cut] + rng.choice(["", "}", '"', ",", "x"]) + text[cut + 1 :]
        payloads.append((text,))
    df = spark.createDataFrame(payloads, "payload string")
    slow = df.select(
        *[F.get_json_object("payload", f"$.{f}").alias(c) for c, f in TOPIC_FIELDS[TRIP_TOPIC].items()]
    )
    fast = [tuple(r) for r in project_payload(df, TRIP_TOPIC).collect()]
    for (payload,), a, b in zip(payloads, fast, slow.collect()):
        assert a == tuple(b), payload
