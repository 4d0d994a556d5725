"""The seven questions on small tables with the awkward rows in them."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from conftest import rows
from tidelake.plans import rental as plans

START = datetime(2021, 3, 1, 10, 0, 0)


def after(**span):
    return START + timedelta(**span)


@pytest.fixture(scope="module")
def tables(spark):
    def frame(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return {
        "category": frame(
            "category_id int, name string", (1, "Children"), (2, "Drama"), (3, "Drama"), (4, "Music"), (5, "Empty")
        ),
        "film_category": frame(
            "film_id int, category_id int", (10, 1), (11, 1), (12, 2), (13, 3), (14, 4), (15, 1), (16, 1), (17, 1)
        ),
        "film": frame(
            "film_id int, title string",
            *[(n, f"film {n}") for n in range(10, 18)], (18, "lost"), (19, "lost"),
        ),
        # Children films per actor: 5, 4, 4, 3, 2.
        "film_actor": frame(
            "actor_id int, film_id int",
            *[(1, f) for f in (10, 11, 15, 16, 17)],
            *[(2, f) for f in (10, 11, 15, 16)],
            *[(3, f) for f in (11, 15, 16, 17)],
            *[(4, f) for f in (10, 11, 15)],
            *[(5, f) for f in (10, 11)],
            (5, 12), (5, 13),
        ),
        "actor": frame(
            "actor_id int, first_name string, last_name string",
            *[(n, f"first {n}", f"last {n}") for n in range(1, 6)],
        ),
        "inventory": frame(
            "inventory_id int, film_id int",
            (100, 10), (101, 10), (102, 11), (103, 12), (104, 13), (105, 14), (106, 15), (107, 16), (108, 17),
        ),
        "rental": frame(
            "rental_id int, inventory_id int, customer_id int, rental_date timestamp_ntz, return_date timestamp_ntz",
            (1, 100, 1, START, after(hours=2, seconds=59)),
            (2, 101, 1, START, after(days=1, minutes=30, seconds=59)),
            (3, 103, 2, START, after(hours=25)),
            (4, 104, 2, START, after(hours=1)),
            (5, 105, 2, START, None),
            (6, 105, 3, START, None),
            (7, 102, 3, START, after(hours=5)),
            (8, 103, 4, START, after(hours=100)),
            (9, 103, 5, START, after(hours=100)),
            (10, 103, 6, START, after(hours=100)),
        ),
        "payment": frame(
            "rental_id int, amount decimal(5,2)",
            (1, Decimal("2.50")), (1, Decimal("0.49")), (3, Decimal("1.99")), (4, Decimal("1.50")), (5, None),
        ),
        "customer": frame(
            "customer_id int, address_id int, active int",
            (1, 1, 1), (2, 2, 0), (3, 3, 1), (4, 4, 1), (5, 5, 0), (6, 6, None), (7, 1, 0), (8, 1, None),
        ),
        "address": frame("address_id int, city_id int", *[(n, n) for n in range(1, 8)]),
        "city": frame(
            "city_id int, city string",
            (1, "Aurora"), (2, "Ab-x"), (3, "x-y"), (4, ""), (5, None), (6, "bern"), (7, "Aurora"),
        ),
    }


def pick(tables, *names):
    return [tables[n] for n in names]


def test_films_per_category_merges_equal_names(tables):
    result = plans.films_per_category(*pick(tables, "film_category", "category"))
    assert [tuple(r) for r in result.collect()] == [("Children", 5), ("Drama", 2), ("Music", 1)]


def brute_force_rentals(tables):
    """Rental counts per actor from the joined rows themselves."""
    film = dict(rows(tables["inventory"]))
    counts = {}
    for rental in tables["rental"].collect():
        for actor, film_id in rows(tables["film_actor"]):
            if film[rental["inventory_id"]] == film_id:
                counts[actor] = counts.get(actor, 0) + 1
    return counts


@pytest.mark.parametrize("k", [1, 3, 10])
def test_most_rented_actors(tables, k):
    result = plans.most_rented_actors(*pick(tables, "rental", "inventory", "film_actor", "actor"), k=k)
    expected = sorted(brute_force_rentals(tables).items(), key=lambda item: (-item[1], item[0]))[:k]
    assert [(r["actor_id"], r["total_rental"]) for r in result.collect()] == expected


def test_top_category_by_amount(tables):
    result = plans.top_category_by_amount(
        *pick(tables, "payment", "rental", "inventory", "film_category", "category")
    )
    # Both categories named Drama together; the payment without an amount adds nothing.
    assert rows(result) == [("Drama", Decimal("3.49"))]


def test_films_not_in_inventory_keeps_equal_titles(tables):
    result = plans.films_not_in_inventory(*pick(tables, "film", "inventory"))
    assert rows(result) == [("lost",), ("lost",)]


def test_top_actors_keeps_ties(tables):
    result = plans.top_actors_in_category(*pick(tables, "film_actor", "film_category", "category", "actor"))
    assert [(r["first_name"], r["film_cnt"]) for r in result.collect()] == [
        ("first 1", 5), ("first 2", 4), ("first 3", 4), ("first 4", 3),
    ]


def test_customers_per_city(tables):
    result = plans.customers_per_city(*pick(tables, "customer", "address", "city"))
    got = {r["city"]: (r["active_customers"], r["not_active_customers"]) for r in result.collect()}
    assert got["Aurora"] == (1, 1)
    assert got["Ab-x"] == (0, 1)
    assert got["bern"] == (None, None)
    inactive = [r["not_active_customers"] for r in result.collect()]
    known = [n for n in inactive if n is not None]
    assert known == sorted(known, reverse=True) and inactive[: len(known)] == known


def test_city_classes(tables):
    exclusive = rows(plans.classified_cities(tables["city"]))
    overlapping = rows(plans.classified_cities(tables["city"], exclusive=False))
    assert exclusive == [
        (1, "starts_with_a"), (2, "starts_with_a"), (3, "contains_hyphen"), (7, "starts_with_a")
    ]
    assert overlapping == sorted([*exclusive, (2, "contains_hyphen")], key=repr)


HOURS = ["rental", "inventory", "film_category", "category", "customer", "address", "city"]


@pytest.mark.parametrize(
    "exclusive, resolution, expected",
    [
        # Customer 2 lives in Ab-x, customer 3 in x-y; Music has only open rentals.
        (True, "second", [("contains_hyphen", "Children", 5.0), ("starts_with_a", "Children", 26.5 + 118 / 3600)]),
        (True, "minute", [("contains_hyphen", "Children", 5.0), ("starts_with_a", "Children", 26.5)]),
        (False, "second", [("contains_hyphen", "Drama", 26.0), ("starts_with_a", "Children", 26.5 + 118 / 3600)]),
        (False, "minute", [("contains_hyphen", "Drama", 26.0), ("starts_with_a", "Children", 26.5)]),
    ],
)
def test_top_category_per_city_class(tables, exclusive, resolution, expected):
    result = plans.top_category_per_city_class(*pick(tables, *HOURS), exclusive=exclusive, resolution=resolution)
    got = rows(result)
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in expected])


def test_open_rentals_sort_last(tables):
    open_only = tables["rental"].filter("inventory_id = 105 OR rental_id = 7")
    result = plans.top_category_per_city_class(open_only, *pick(tables, *HOURS[1:]))
    assert rows(result) == [("contains_hyphen", "Children", 5.0), ("starts_with_a", "Music", None)]


def test_rental_hours_over_a_clock_change(spark, conf):
    conf("spark.sql.session.timeZone", "Europe/Berlin")
    night = (datetime(2021, 3, 28, 1, 0, 0), datetime(2021, 3, 28, 5, 0, 0))
    ntz = spark.createDataFrame([(1, *night)], "k int, rental_date timestamp_ntz, return_date timestamp_ntz")
    zoned = ntz.select(
        "k", *[ntz[c].cast("timestamp").alias(c) for c in ("rental_date", "return_date")]
    )
    assert rows(plans.rental_hours(ntz, "k")) == [(1, 4.0)]
    assert rows(plans.rental_hours(zoned, "k")) == [(1, 3.0)]


def test_seconds_drop_the_fraction_of_each_side(spark):
    late = datetime(2021, 1, 1, 0, 0, 0, 900_000)
    early = datetime(2021, 1, 1, 0, 0, 2, 100_000)
    frame = spark.createDataFrame([(1, late, early)], "k int, rental_date timestamp_ntz, return_date timestamp_ntz")
    assert rows(plans.rental_hours(frame, "k")) == [(1, 2 / 3600)]


def test_unknown_resolution(spark, tables):
    with pytest.raises(ValueError):
        plans.rental_hours(tables["rental"], "rental_id", resolution="day")
