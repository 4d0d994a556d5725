"""Seven questions over a film rental schema.

Each function takes the tables it needs as DataFrames, with the columns
``category(category_id, name)``, ``film_category(film_id, category_id)``,
``film(film_id, title)``, ``actor(actor_id, first_name, last_name)``,
``film_actor(actor_id, film_id)``, ``inventory(inventory_id, film_id)``,
``rental(rental_id, inventory_id, customer_id, rental_date, return_date)``,
``payment(rental_id, amount)``, ``customer(customer_id, address_id, active)``,
``address(address_id, city_id)`` and ``city(city_id, city)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelake.functions.durations import UNITS_PER_HOUR, with_duration
from tidelake.functions.text import CITY_CLASSES, Rules, exclusive_class, overlapping_classes
from tidelake.operators.ranking import top1_per_class, top_k, top_n_dense
from tidelake.operators.rollup import roll_up, totals
from tidelake.operators.skew import lookup_join, unreferenced


def films_per_category(film_category: DataFrame, category: DataFrame) -> DataFrame:
    """(category, film_cnt), most films first. Categories of one name count as one."""
    films = film_category.select("category_id", F.lit(1).cast("long").alias("film_cnt"))
    named = roll_up(films, category, "category_id", "name", "film_cnt", to_one=True).withColumnRenamed("name", "category")
    return totals(named, "category", "film_cnt").orderBy(F.desc("film_cnt"), "category")


def most_rented_actors(
    rental: DataFrame, inventory: DataFrame, film_actor: DataFrame, actor: DataFrame, k: int = 10
) -> DataFrame:
    """The ``k`` actors whose films were rented most: (actor_id, first_name, last_name, total_rental).

    A film with many rentals and many actors would multiply them in a join of the
    rows; here its rentals are one number before they meet the actors.
    """
    rentals = rental.select("inventory_id", F.lit(1).cast("long").alias("total_rental"))
    per_film = roll_up(rentals, inventory, "inventory_id", "film_id", "total_rental", to_one=True)
    per_actor = roll_up(per_film, film_actor, "film_id", "actor_id", "total_rental")
    columns = ["actor_id", "first_name", "last_name"]
    named = roll_up(per_actor, actor, "actor_id", columns, "total_rental", to_one=True)
    return top_k(totals(named, columns, "total_rental"), "total_rental", k, ["actor_id"])


def top_category_by_amount(
    payment: DataFrame, rental: DataFrame, inventory: DataFrame, film_category: DataFrame, category: DataFrame
) -> DataFrame:
    """The category on which most money was spent: (name, total_amount)."""
    paid = payment.select("rental_id", F.col("amount").alias("total_amount"))
    per_item = roll_up(paid, rental, "rental_id", "inventory_id", "total_amount", to_one=True)
    per_film = roll_up(per_item, inventory, "inventory_id", "film_id", "total_amount", to_one=True)
    per_category = roll_up(per_film, film_category, "film_id", "category_id", "total_amount")
    named = roll_up(per_category, category, "category_id", "name", "total_amount", to_one=True)
    return top_k(totals(named, "name", "total_amount"), "total_amount", 1, ["name"])


def films_not_in_inventory(film: DataFrame, inventory: DataFrame) -> DataFrame:
    """Titles of the films without a copy; equal titles of different films all stay."""
    return unreferenced(film, inventory, "film_id").select("title")


def top_actors_in_category(
    film_actor: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    actor: DataFrame,
    name: str = "Children",
    n: int = 3,
) -> DataFrame:
    """Actors with the ``n`` highest film counts in one category, all ties: (first_name, last_name, film_cnt)."""
    # With the same filters on both uses of the counts their shuffle runs once.
    film_actor = film_actor.dropna(subset=["film_id", "actor_id"])
    ids = category.filter(F.col("name") == name).select("category_id")
    films = lookup_join(film_category, ids, "category_id").select("film_id", F.lit(1).cast("long").alias("film_cnt"))
    per_actor = roll_up(films, film_actor, "film_id", "actor_id", "film_cnt")
    best = top_n_dense(totals(per_actor, "actor_id", "film_cnt"), "film_cnt", n)
    return (
        best.join(actor, "actor_id")
        .select("first_name", "last_name", "film_cnt")
        .orderBy(F.desc("film_cnt"), "last_name", "first_name")
    )


def customers_per_city(customer: DataFrame, address: DataFrame, city: DataFrame) -> DataFrame:
    """(city, active_customers, not_active_customers), most inactive first; an unknown flag counts for neither."""
    measures = ["active_customers", "not_active_customers"]
    flags = customer.select(
        "address_id",
        F.col("active").cast("long").alias("active_customers"),
        (1 - F.col("active")).cast("long").alias("not_active_customers"),
    )
    per_city = roll_up(flags, address, "address_id", "city_id", measures, to_one=True)
    named = roll_up(per_city, city, "city_id", "city", measures, to_one=True)
    return totals(named, "city", measures).orderBy(F.desc("not_active_customers"), "city")


def classified_cities(city: DataFrame, rules: Rules = CITY_CLASSES, exclusive: bool = True) -> DataFrame:
    """(city_id, city_type) of the cities with a class; several rows for several classes unless ``exclusive``."""
    if exclusive:
        typed = city.select("city_id", exclusive_class(F.col("city"), rules).alias("city_type"))
        return typed.filter("city_type IS NOT NULL")
    return city.select("city_id", F.explode(overlapping_classes(F.col("city"), rules)).alias("city_type"))


def top_category_per_city_class(
    rental: DataFrame,
    inventory: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    customer: DataFrame,
    address: DataFrame,
    city: DataFrame,
    rules: Rules = CITY_CLASSES,
    exclusive: bool = True,
    resolution: str = "second",
    rental_keys: DataFrame | None = None,
) -> DataFrame:
    """Per class of city, the category with most rental hours: (city_type, name, total_rental_hours).

    ``exclusive`` gives a city the first class that fits, otherwise all that fit, in
    the same single pass over the rentals. ``resolution`` is that of one rental.
    ``rental_keys(customer_id)`` is a table to look for hot customers in, if ``rental``
    itself is the result of joins.
    """
    hours = with_duration(rental, "rental_date", "return_date", "units", resolution)
    hours = hours.select("inventory_id", "customer_id", "units")
    # Customers, addresses and cities are tables of known size; a join of them would not be.
    homes = lookup_join(hours, customer.select("customer_id", "address_id"), "customer_id", keys_from=rental_keys)
    per_city = roll_up(homes, address, "address_id", "city_id", "units", carry="inventory_id", to_one=True)
    # A city has at most as many targets as there are classes, so none is hot.
    cities = classified_cities(city, rules, exclusive)
    classed = roll_up(per_city, cities, "city_id", "city_type", "units", carry="inventory_id", to_one=True)
    # Films are summed up to here, where a film may have several categories: one row per class, however many rentals it had.
    per_film = roll_up(classed, inventory, "inventory_id", "film_id", "units", carry="city_type", to_one=True)
    per_category = roll_up(per_film, film_category, "film_id", "category_id", "units", carry="city_type")
    named = roll_up(per_category, category, "category_id", "name", "units", carry="city_type", to_one=True)
    best = top1_per_class(totals(named, ["city_type", "name"], "units"), "city_type", "units", "name")
    return best.select(
        "city_type", "name", (F.col("units") / UNITS_PER_HOUR[resolution]).alias("total_rental_hours")
    ).orderBy("city_type")


def rental_hours(rental: DataFrame, by: str, resolution: str = "second") -> DataFrame:
    """Total hours between rental and return per ``by``: (by, total_rental_hours)."""
    timed = with_duration(rental, "rental_date", "return_date", "units", resolution)
    hours = (F.col("units") / UNITS_PER_HOUR[resolution]).alias("total_rental_hours")
    return totals(timed, by, "units").select(by, hours)
