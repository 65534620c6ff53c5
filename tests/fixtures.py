"""Fixture rows from FIXTURES.md (parts A and B) as bronze DataFrames."""

import datetime as dt

from strata.schemas import RAW_FESTIVAL_CALENDAR, RAW_IPL_SCHEDULE, RAW_ORDERS, RAW_RESTAURANTS, RAW_WEATHER

T1 = dt.datetime(2023, 1, 5, 10, 0)
T2 = dt.datetime(2023, 1, 6, 10, 0)


def frame(spark, schema, dict_rows):
    """Rows -> DataFrame; every field nullable so raw-feed NULL keys can be staged."""
    from pyspark.sql.types import StructField, StructType

    loose = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in dict_rows], loose)


def order(oid, day, when, amount, status="delivered", mins=30, gen=T1, city="Delhi", rid=1):
    return {"order_id": oid, "order_date": day, "order_datetime": when, "order_amount_inr": amount,
            "order_status": status, "delivery_time_mins": mins, "_generated_at": gen, "city": city,
            "restaurant_id": rid, "payment_method": "UPI", "platform": "app"}


def b1_orders(spark):
    d1, d2 = dt.date(2023, 1, 1), dt.date(2023, 1, 2)
    at = lambda d, h, m=0: dt.datetime(d.year, d.month, d.day, h, m)
    rows = [
        order("o1", d1, at(d1, 12, 30), 100.0, gen=T1),
        order("o1", d1, at(d1, 12, 30), 200.0, gen=T2),
        order("o2", d2, at(d2, 9), 500.0, gen=T1),
        order("o2", d2, at(d2, 9), 10001.0, gen=T2),
        order("o3", d2, at(d2, 10), 10000.0, mins=20),
        order("o4", d2, at(d2, 10), 0.0, mins=20),
        order("o5", d2, at(d2, 10), None, mins=20),
        order("o6", dt.date(2019, 12, 31), dt.datetime(2019, 12, 31, 10), 50.0, mins=20),
        order(None, d2, at(d2, 10), 50.0, mins=20),
        order("o7", d2, None, 50.0, status=None, mins=20),
        order("o8", d2, at(d2, 11), 50.0, mins=0),
        order("o9", d2, at(d2, 11), 50.0, status="cancelled", mins=5),
        order("o9", d2, at(d2, 11), 60.0, status="cancelled", mins=5),
    ]
    return frame(spark, RAW_ORDERS, rows)


def weather(city, day, tmax, tmin, precip, fetched=T1, rainy=None):
    return {"city": city, "weather_date": day, "temperature_max": tmax, "temperature_min": tmin,
            "precipitation_sum": precip, "is_rainy": rainy, "_fetched_at": fetched, "weather_code": 0}


def b2_weather(spark):
    return frame(spark, RAW_WEATHER, [
        weather(" bengaluru ", dt.date(2023, 10, 5), 30.0, 20.0, 15.0),
        weather("NEW DELHI", dt.date(2023, 6, 1), 41.0, 30.0, 0.0),
        weather("bombay", dt.date(2023, 12, 1), 40.0, 25.0, 2.5),
        weather("new york", dt.date(2023, 3, 1), 35.0, 20.0, 0.0),
        weather("pune", dt.date(2023, 7, 1), None, 20.0, float("nan")),
        weather("Bangalore", dt.date(2023, 1, 1), 28.0, 18.0, 0.0),
        weather("Bengaluru", dt.date(2023, 1, 1), 29.0, 18.0, 0.0),
        weather("pune", dt.date(2023, 7, 2), 30.0, 20.0, 1.0, fetched=T1),
        weather("pune", dt.date(2023, 7, 2), 31.0, 20.0, 20.0, fetched=T2),
    ])


def restaurant(rid, rating=4.0, cuisines="Italian", price=1, votes=10, ingested=T1, city="Delhi"):
    return {"restaurant_id": rid, "restaurant_name": f" R{rid} ", "city": city, "cuisines": cuisines,
            "average_cost_for_two": 500, "has_online_delivery": True, "price_range": price,
            "aggregate_rating": rating, "votes": votes, "_ingested_at": ingested, "country_code": 1}


def b3_restaurants(spark):
    rows = [
        restaurant(1, 4.5, " Biryani , Thai", 1), restaurant(2, 4.0, None, 2), restaurant(3, 3.5, "", 3),
        restaurant(4, 3.0, "Italian", 4), restaurant(5, 2.9, price=5), restaurant(6, 0.0, price=None),
        restaurant(7, 5.1), restaurant(8, -1.0), restaurant(9, None),
        restaurant(10, 1.0, votes=10), restaurant(10, 2.0, votes=20),
        restaurant(11, 1.0, votes=5, ingested=T1), restaurant(11, 2.0, votes=5, ingested=T2),
        restaurant(12, 1.0, votes=None), restaurant(12, 2.0, votes=1),
        restaurant(None, 3.0),
    ]
    return frame(spark, RAW_RESTAURANTS, rows)


def a2_ipl(spark):
    def m(day, no, t1, t2, city, mtype, ing=T1, flag=True):
        return {"match_date": day, "season": 2023, "match_number": no, "team1": t1, "team2": t2,
                "venue_city": city, "match_type": mtype, "is_service_city": flag, "_ingested_at": ing}
    return frame(spark, RAW_IPL_SCHEDULE, [
        m(dt.date(2023, 4, 2), 3, "RCB", "MI", "Bangalore", "league"),
        m(dt.date(2023, 4, 2), 3, "RCB", "MI", "Bangalore", "League ", ing=T2),
        m(dt.date(2023, 4, 9), 10, "DC", "PBKS", "Delhi", "league"),
        m(dt.date(2023, 5, 28), 70, "CSK", "GT", "Ahmedabad", " Final", flag=False),
        m(dt.date(2023, 5, 26), 69, None, "GT", "Ahmedabad", "qualifier", flag=False),
    ])


def a3_festivals(spark):
    def f(day, name, ftype, region, major, ing=T1):
        return {"festival_date": day, "festival_name": name, "festival_type": ftype, "region": region,
                "is_major": major, "_ingested_at": ing}
    return frame(spark, RAW_FESTIVAL_CALENDAR, [
        f(dt.date(2023, 11, 12), "Diwali", "religious", "all", True),
        f(dt.date(2023, 11, 12), "Diwali", "religious ", "all", True, ing=T2),
        f(dt.date(2023, 11, 12), "Kali Puja", "regional", "east", False),
        f(dt.date(2023, 1, 26), "Republic Day", "national", " all", False),
        f(dt.date(2023, 1, 15), "Pongal", "regional", "south", False),
    ])
