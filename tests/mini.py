"""Nine small raw tables with one planted defect each; expectations are worked out by hand."""

import datetime as dt

from gleanstar.sources.schemas import RAW_SCHEMAS


def ts(text):
    return None if text is None else dt.datetime.fromisoformat(text)


def order(key, customer, status, bought, approved, carrier, delivered, estimated):
    return (key, customer, status, *[ts(x) for x in (bought, approved, carrier, delivered, estimated)])


ROWS = {
    "orders": [
        # on time
        order("o1", "c1", "delivered", "2017-01-05 10:00:00", "2017-01-05 11:00:00", "2017-01-06 12:30:00", "2017-01-10 12:00:00", "2017-01-12 00:00:00"),
        # same-day late: error 0 days, yet not on time
        order("o2", "c2", " Delivered ", "2017-02-01 08:00:00", "2017-02-01 09:00:00", "2017-02-02 09:00:00", "2017-02-10 15:00:00", "2017-02-10 00:00:00"),
        # delivered before carrier, and late
        order("o3", "c3", "delivered", "2017-03-01 00:00:00", "2017-03-01 01:00:00", "2017-03-20 00:00:00", "2017-03-18 06:00:00", "2017-03-10 00:00:00"),
        # carrier before approval
        order("o4", "c4", "delivered", "2018-01-01 00:00:00", "2018-01-03 00:00:00", "2018-01-02 12:30:00", "2018-01-06 00:00:00", "2018-01-20 00:00:00"),
        # delivered without final date only
        order("o5", "c5", "delivered", "2018-02-01 00:00:00", "2018-02-01 02:00:00", "2018-02-03 00:00:00", None, "2018-02-20 00:00:00"),
        # delivered without several dates, without approval and carrier
        order("o6", "c6", "delivered", "2018-03-01 00:00:00", None, None, None, "2018-03-20 00:00:00"),
        # canceled with delivery date
        order("o7", "c7", "canceled", "2018-04-01 00:00:00", "2018-04-01 05:00:00", "2018-04-02 00:00:00", "2018-04-08 00:00:00", "2018-04-20 00:00:00"),
        # expected NULL
        order("o8", "c8", "shipped", "2018-05-01 00:00:00", "2018-05-01 05:00:00", "2018-05-02 00:00:00", None, "2018-05-20 00:00:00"),
        # NULL status; unknown customer; no items
        order("o9", "c99", None, "2018-06-01 00:00:00", "2018-06-01 05:00:00", None, None, "2018-06-20 00:00:00"),
        # second order of the person behind c1 and c10, same time as o1: order id decides
        order("o10", "c10", "delivered", "2017-01-05 10:00:00", "2017-01-05 12:00:00", "2017-01-07 12:00:00", "2017-01-09 12:00:00", "2017-01-12 00:00:00"),
    ],
    "customers": [
        ("c1", "p1", 1310, " Sao Paulo", "sp"),
        ("c10", "p1", 20040, "rio de janeiro", "RJ"),
        ("c2", "p2", 1310, "SAO PAULO ", "SP"),
        ("c3", "p3", 30110, "belo horizonte", "MG"),
        ("c4", "p4", 99999, "nowhere", "XX"),
        ("c5", "p5", 1310, "sao paulo", "SP"),
        # same city in two spellings: not two cities
        ("c6", "p6", 1310, "Campinas", "SP"),
        ("c7", "p6", 1310, "campinas ", "SP"),
        ("c8", "p8", 123, "santos", "SP"),
        # a person without orders
        ("c11", "p11", 1310, "sao paulo", "SP"),
    ],
    "order_items": [
        ("o1", 1, "d1", "s1", ts("2017-01-08"), 100.0, 10.0),
        ("o1", 2, "d2", "s2", ts("2017-01-08"), 50.0, 0.0),
        ("o2", 1, "d1", " s1 ", ts("2017-02-04"), 100.0, 12.5),
        ("o3", 1, "d3", "s2", ts("2017-03-05"), 0.0, 5.0),
        ("o4", 1, "d4", "s3", ts("2020-02-05"), 20.0, 5.0),
        # NULL shipping limit: NULL flag
        ("o5", 1, "d2", "s1", None, 50.0, 7.0),
        ("o6", 1, "d5", "s1", ts("2018-03-05"), 10.0, 1.0),
        ("o7", 1, "d1", "s4", ts("2018-04-05"), 100.0, 1.0),
        ("o8", 1, "d2", "s1", ts("2018-05-05"), 50.0, 1.0),
        # order, product and seller unknown
        ("o404", 1, "d404", "s404", ts("2018-05-05"), 5.0, 1.0),
        # equal dearest prices: the category decides
        ("o10", 1, "d2", "s2", ts("2017-01-08"), 70.0, 2.0),
        ("o10", 2, "d1", "s2", ts("2017-01-08"), 70.0, 2.0),
        ("o10", 2, "d1", "s2", ts("2017-01-09"), 30.0, 2.0),
    ],
    "order_payments": [
        ("o1", 1, "credit_card", 3, 110.0),
        ("o1", 2, "voucher", 1, 50.0),
        ("o2", 2, " Credit_Card", 1, 112.5),
        ("o3", 1, "not_defined", 0, 0.0),
        ("o4", 1, "boleto", 1, 25.0),
        ("o4", 3, "voucher", 1, 0.0),
        ("o5", 1, "boleto", 1, None),
        ("o77", 1, "boleto", 1, 5.0),
    ],
    "order_reviews": [
        ("r1", "o1", 5, None, "  great ", ts("2017-01-11"), ts("2017-01-12 10:00:00")),
        ("r2", "o1", 1, "bad", None, ts("2017-01-11"), ts("2017-01-13 10:00:00")),
        ("r3", "o2", 4, None, None, ts("2017-02-11"), ts("2017-02-10 10:00:00")),
        ("r4", "o3", 6, None, "", ts("2017-03-21"), ts("2017-03-22 10:00:00")),
        ("r4", "o4", 0, None, "ok", ts("2018-01-07"), ts("2018-01-08 10:00:00")),
        ("r6", "o3", 2, None, None, ts("2017-03-25"), ts("2017-03-26 10:00:00")),
        ("r7", "o88", 3, None, None, ts("2017-03-25"), ts("2017-03-26 10:00:00")),
    ],
    "products": [
        ("d1", " Toys", 10, 100, 1, 500, 10, 5, 5),
        ("d2", "books", 12, 120, 2, 300, 20, 2, 10),
        ("d3", "toys", 8, 80, 1, 0, 10, 5, 5),
        ("d4", "cool_stuff", 8, 80, None, 250, 30, 5, 5),
        # NULL category with zero weight: no group to impute from
        ("d5", None, None, None, None, 0, 10, 5, 5),
        ("d6", "toys", 8, 80, 1, 700, 10, 5, 5),
        ("d7", "books", 8, 80, 1, None, 10, 5, 5),
    ],
    "sellers": [
        ("s1", 1310, "garulhos", " sp"),
        ("s2", 1310, "Sao Paulo SP ", "SP"),
        ("s3", 99999, "sp", "SP"),
        ("s4", 20040, "rio de janeiro", "RJ"),
        # without items
        ("s5", 1310, "04482255", "RJ"),
    ],
    "geolocation": [
        (1310, -34.0, -75.0, "São Paulo", "SP"),
        (1310, 6.0, -33.0, "SÃO PAULO ", "SP"),
        (1310, -23.5, -46.6, "sao paulo", "sp"),
        # zip with two real cities
        (20040, -22.9, -43.2, "rio de janeiro", "RJ"),
        (20040, -22.9, -43.2, "niterói", "RJ"),
        # outside the box, or without latitude
        (30110, 6.1, -43.9, "belo horizonte", "MG"),
        (30110, None, -43.9, "belo horizonte", "MG"),
        (30110, -19.9, -43.9, "belo horizonte", "MG"),
        (30110, -19.9, -32.9, "belo horizonte", "MG"),
    ],
    "category_translation": [
        ("toys", " Toys"),
        ("books", "Books "),
        ("unused", "never"),
    ],
}


def raw_tables(spark):
    return {name: spark.createDataFrame(ROWS[name], schema).coalesce(1) for name, schema in RAW_SCHEMAS.items()}
