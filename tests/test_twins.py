"""The seven questions against SQL on random tables, by broadcasts and by salted shuffles."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from tidelake.plans import rental as plans

SCHEMAS = {
    "category": "category_id bigint, name string",
    "film_category": "film_id bigint, category_id bigint",
    "film": "film_id bigint, title string",
    "actor": "actor_id bigint, first_name string, last_name string",
    "film_actor": "actor_id bigint, film_id bigint",
    "inventory": "inventory_id bigint, film_id bigint",
    "rental": "rental_id bigint, inventory_id bigint, customer_id bigint, rental_date timestamp_ntz, return_date timestamp_ntz",
    "payment": "rental_id bigint, amount decimal(5,2)",
    "customer": "customer_id bigint, address_id bigint, active int",
    "address": "address_id bigint, city_id bigint",
    "city": "city_id bigint, city string",
}
CITIES = ["Aurora", "Ab-x", "x-y", "", None, "bern", "aachen", "Zug", "Zug", "-"]


def random_tables(seed):
    """Small tables in which one film, one actor and one customer have a third of everything."""
    r = random.Random(seed)

    def skewed(n):
        return 1 if r.random() < 0.33 else r.randint(1, n)

    def sometimes(value, share=0.1):
        return None if r.random() < share else value

    def rental(n):
        start = datetime(2021, 1, 1) + timedelta(seconds=r.randint(0, 10**6))
        back = sometimes(start + timedelta(seconds=r.randint(0, 10**6)))
        return (n, sometimes(skewed(40)), sometimes(skewed(20)), start, back)

    return {
        "category": [(n, r.choice(["Children", "Drama", "Music"])) for n in range(1, 6)],
        "film_category": [(skewed(30), sometimes(r.randint(1, 6))) for _ in range(60)],
        "film": [(n, f"film {n % 7}") for n in range(1, 36)],
        "actor": [(n, f"f{n}", f"l{n % 3}") for n in range(1, 16)],
        "film_actor": [(sometimes(skewed(16)), sometimes(skewed(30))) for _ in range(120)],
        "inventory": [(n, sometimes(skewed(30))) for n in range(1, 41)],
        "rental": [rental(n) for n in range(1, 201)],
        "payment": [(sometimes(skewed(200)), sometimes(Decimal(r.randint(0, 99999)) / 100)) for _ in range(200)],
        "customer": [(n, sometimes(r.randint(1, 12)), sometimes(r.randint(0, 1))) for n in range(1, 21)],
        "address": [(n, sometimes(r.randint(1, 11))) for n in range(1, 13)],
        "city": [(n, name) for n, name in enumerate(CITIES, 1)],
    }


def hours_sql(classes, hours):
    return f"""
        WITH typed AS ({classes}),
        per_group AS (
            SELECT city_type, name, SUM({hours}) AS units
            FROM rental
            JOIN inventory USING (inventory_id) JOIN film_category USING (film_id) JOIN category USING (category_id)
            JOIN customer USING (customer_id) JOIN address USING (address_id) JOIN typed USING (city_id)
            GROUP BY ALL)
        SELECT city_type, name, units FROM per_group
        QUALIFY ROW_NUMBER() OVER (PARTITION BY city_type ORDER BY units DESC NULLS LAST, name) = 1"""


FIRST_CLASS = """
    SELECT city_id, IF(lower(city[1]) = 'a', 'starts_with_a', 'contains_hyphen') AS city_type
    FROM city WHERE lower(city[1]) = 'a' OR contains(city, '-')"""
ALL_CLASSES = """
    SELECT city_id, 'starts_with_a' AS city_type FROM city WHERE lower(city[1]) = 'a'
    UNION ALL SELECT city_id, 'contains_hyphen' FROM city WHERE contains(city, '-')"""
SECONDS = "date_diff('second', rental_date, return_date)"
MINUTES = "(epoch(return_date) - epoch(rental_date))::BIGINT // 60"

QUESTIONS = {
    "films_per_category": (
        lambda t: plans.films_per_category(t["film_category"], t["category"]),
        "SELECT name, COUNT(*) FROM category JOIN film_category USING (category_id) GROUP BY name",
    ),
    "most_rented_actors": (
        lambda t: plans.most_rented_actors(t["rental"], t["inventory"], t["film_actor"], t["actor"], k=5),
        """SELECT actor_id, first_name, last_name, COUNT(*) AS n
           FROM actor JOIN film_actor USING (actor_id) JOIN inventory USING (film_id) JOIN rental USING (inventory_id)
           GROUP BY ALL ORDER BY n DESC, actor_id LIMIT 5""",
    ),
    "top_category_by_amount": (
        lambda t: plans.top_category_by_amount(
            t["payment"], t["rental"], t["inventory"], t["film_category"], t["category"]
        ),
        """SELECT name, SUM(amount) AS total
           FROM payment JOIN rental USING (rental_id) JOIN inventory USING (inventory_id)
           JOIN film_category USING (film_id) JOIN category USING (category_id)
           GROUP BY name ORDER BY total DESC NULLS LAST, name LIMIT 1""",
    ),
    "films_not_in_inventory": (
        lambda t: plans.films_not_in_inventory(t["film"], t["inventory"]),
        "SELECT title FROM film WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.film_id = film.film_id)",
    ),
    "top_actors_in_category": (
        lambda t: plans.top_actors_in_category(t["film_actor"], t["film_category"], t["category"], t["actor"]),
        """SELECT first_name, last_name, n FROM (
               SELECT actor_id, COUNT(*) AS n, DENSE_RANK() OVER (ORDER BY COUNT(*) DESC) AS place
               FROM film_actor JOIN film_category USING (film_id) JOIN category USING (category_id)
               WHERE name = 'Children' AND actor_id IS NOT NULL GROUP BY actor_id)
           JOIN actor USING (actor_id) WHERE place <= 3""",
    ),
    "customers_per_city": (
        lambda t: plans.customers_per_city(t["customer"], t["address"], t["city"]),
        """SELECT city, SUM(active)::BIGINT, SUM(1 - active)::BIGINT
           FROM customer JOIN address USING (address_id) JOIN city USING (city_id) GROUP BY city""",
    ),
}


def hours_question(exclusive, resolution):
    tables = ["rental", "inventory", "film_category", "category", "customer", "address", "city"]
    unit, per_hour = (SECONDS, 3600) if resolution == "second" else (MINUTES, 60)
    sql = hours_sql(FIRST_CLASS if exclusive else ALL_CLASSES, unit)
    return (
        lambda t: plans.top_category_per_city_class(
            *[t[n] for n in tables], exclusive=exclusive, resolution=resolution
        ),
        f"SELECT city_type, name, units / {per_hour}.0::DOUBLE FROM ({sql})",
    )


for exclusive in (True, False):
    for resolution in ("second", "minute"):
        QUESTIONS[f"hours_{'first' if exclusive else 'all'}_{resolution}"] = hours_question(exclusive, resolution)


@pytest.fixture(scope="module", params=[1, 2, 3])
def data(request, spark):
    tables = random_tables(request.param)
    connection = duckdb.connect()
    types = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}
    for name, rows in tables.items():
        columns = [c.split(" ") for c in SCHEMAS[name].split(", ")]
        ddl = ", ".join(f"{c} {types.get(t, t)}" for c, t in columns)
        connection.execute(f"CREATE TABLE {name} ({ddl})")
        connection.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(columns))})", rows)
    return {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in tables.items()}, connection


def listed(rows):
    return sorted((tuple(None if pd.isna(v) else v for v in row) for row in rows), key=repr)


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("question", sorted(QUESTIONS))
def test_equals_sql(data, conf, question, shuffled):
    tables, connection = data
    if shuffled:
        conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    ask, sql = QUESTIONS[question]
    assert listed(ask(tables).collect()) == listed(connection.execute(sql).fetchall())
