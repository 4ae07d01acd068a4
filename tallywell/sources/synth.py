"""Synthetic clients, products and transactions, any number of them, in parallel.

A row is a function of its number and the seed alone, so any task can make any row,
a lost one is made again the same, and a transaction can name a client without a
list of clients. Numbers stand in for random picks by three rounds of arithmetic
modulo a prime, which keeps every expression inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: what the generated data is made of -------------------------

FIRST_NAMES = (
    "James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda",
    "David", "Elizabeth", "William", "Barbara", "Richard", "Susan", "Joseph", "Jessica",
    "Thomas", "Sarah", "Charles", "Karen", "Emma", "Oliver", "Ava", "Liam", "Sophia",
    "Noah", "Isabella", "Ethan", "Mia", "Lucas", "Charlotte", "Mason", "Amelia",
    "Logan", "Harper", "Alexander", "Evelyn", "Aiden", "Abigail", "Jackson",
)
LAST_NAMES = (
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis",
    "Rodriguez", "Martinez", "Hernandez", "Lopez", "Gonzalez", "Wilson", "Anderson",
    "Thomas", "Taylor", "Moore", "Jackson", "Martin", "Lee", "Perez", "Thompson",
    "White", "Harris", "Sanchez", "Clark", "Ramirez", "Lewis", "Robinson",
)
CITIES = {
    "United States": ("New York", "Los Angeles", "Chicago", "Houston", "Phoenix", "Seattle"),
    "United Kingdom": ("London", "Manchester", "Birmingham", "Leeds", "Glasgow"),
    "Canada": ("Toronto", "Vancouver", "Montreal", "Calgary", "Ottawa"),
    "Germany": ("Berlin", "Munich", "Hamburg", "Frankfurt", "Cologne"),
    "France": ("Paris", "Lyon", "Marseille", "Toulouse", "Nice"),
    "Australia": ("Sydney", "Melbourne", "Brisbane", "Perth", "Adelaide"),
    "Japan": ("Tokyo", "Osaka", "Yokohama", "Nagoya", "Sapporo"),
    "Brazil": ("São Paulo", "Rio de Janeiro", "Brasília", "Salvador", "Fortaleza"),
    "India": ("Mumbai", "Delhi", "Bangalore", "Chennai", "Kolkata"),
    "Mexico": ("Mexico City", "Guadalajara", "Monterrey", "Puebla", "Cancún"),
    "Spain": ("Madrid", "Barcelona", "Valencia", "Seville", "Bilbao"),
    "Italy": ("Rome", "Milan", "Naples", "Turin", "Florence"),
    "Netherlands": ("Amsterdam", "Rotterdam", "The Hague", "Utrecht", "Eindhoven"),
    "Sweden": ("Stockholm", "Gothenburg", "Malmö", "Uppsala", "Linköping"),
    "South Korea": ("Seoul", "Busan", "Incheon", "Daegu", "Daejeon"),
}
SEGMENTS = ("Premium", "Standard", "Budget", "Enterprise", "VIP")
SUB_CATEGORIES = {
    "Electronics": ("Smartphones", "Laptops", "Tablets", "Headphones", "Cameras"),
    "Clothing": ("T-Shirts", "Jeans", "Dresses", "Jackets", "Shoes"),
    "Home & Garden": ("Furniture", "Lighting", "Kitchenware", "Bedding", "Decor"),
    "Sports": ("Running Shoes", "Yoga Mats", "Weights", "Bicycles", "Jerseys"),
    "Books": ("Fiction", "Non-Fiction", "Comics", "Textbooks", "Audiobooks"),
    "Beauty": ("Skincare", "Makeup", "Fragrances", "Haircare", "Nail Care"),
    "Food & Beverage": ("Coffee", "Tea", "Snacks", "Supplements", "Organic"),
    "Toys": ("Action Figures", "Board Games", "Puzzles", "Dolls", "LEGO"),
}
# lowest and highest price in whole units
PRICES = {
    "Electronics": (50, 2000),
    "Clothing": (10, 300),
    "Home & Garden": (20, 1000),
    "Sports": (15, 500),
    "Books": (5, 100),
    "Beauty": (8, 200),
    "Food & Beverage": (3, 100),
    "Toys": (5, 200),
}
BRANDS = (
    "TechNova", "UrbanStyle", "HomeComfort", "SportsPro", "BookWorm",
    "GlowUp", "NutriPlus", "FunFactory", "EcoSmart", "PrimeLine",
    "VoltEdge", "AquaPure", "ZenithGear", "NexGen", "Artisan Co",
)
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "bank_transfer", "crypto")
# a value's slots are its weight
STATUSES = ("completed", "completed", "completed", "completed", "pending", "refunded")
CURRENCIES = ("USD", "USD", "USD", "EUR", "GBP", "CAD", "JPY")

AGES = (18, 79)
STOCK = (0, 4999)
QUANTITY = (1, 10)
NAME_NUMBER = (1000, 9999)
MAIL_NUMBER = (0, 998)
WEIGHT_CENTS = (10, 3000)
RATING_CENTS = (100, 500)
UNIT_PRICE_CENTS = (500, 100_000)
REGISTERED_DAYS = (0, 1824)
RECENT_SECONDS = (0, 7 * 86_400 - 1)

# --- fixed values: the stand-in for random numbers ----------------------------

PRIME = 2_147_483_647
STEP_A, STEP_B, STEP_C = 48_271, 69_621, 16_807

def noise(n: Column, salt: int, seed: int) -> Column:
    """A number below ``PRIME`` that looks unrelated for each ``n`` and ``salt``."""
    shift = (seed * STEP_C + salt * 1_000_003) % PRIME
    first = (n % PRIME * STEP_A + F.floor(n / PRIME) * STEP_C + shift) % PRIME
    second = (first * first + salt) % PRIME
    return second * STEP_B % PRIME


class _Row:
    """Picks for the row numbered by ``n``; each gets a salt of its own."""

    def __init__(self, n: Column, seed: int):
        self.n, self.seed, self.salt = n, seed, 0

    def below(self, size: Column | int) -> Column:
        self.salt += 1
        return noise(self.n, self.salt, self.seed) % size

    def number(self, count: int) -> Column:
        """Any row number below ``count``, which may be far above the prime."""
        return (self.below(PRIME) * PRIME + self.below(PRIME)) % count

    def between(self, bounds: tuple[int, int]) -> Column:
        low, high = bounds
        return self.below(high - low + 1) + low

    def one_of(self, values) -> Column:
        return _at(F.array(*(F.lit(v) for v in values)), self.below(len(values)))


def _at(values: Column, index: Column) -> Column:
    return F.element_at(values, (index + 1).cast("int"))


def _arrays(table: dict[str, tuple]) -> Column:
    return F.array(*(F.array(*(F.lit(v) for v in values)) for values in table.values()))


def _id(prefix: str, n: Column) -> Column:
    """The row number in at least eight hex digits: unique without any check."""
    digits = F.lower(F.hex(n))
    # lpad cuts longer texts down to its width
    width = F.greatest(F.length(digits), F.lit(8))
    return F.concat(F.lit(prefix), F.lpad(digits, width, F.lit("0")))


def _cents(cents: Column) -> Column:
    return cents / F.lit(100.0)


def _ago(base_ts: str, seconds: Column) -> Column:
    """ISO text of the moment some seconds before ``base_ts``, a UTC time."""
    base = F.lit(base_ts).cast("timestamp_ntz")
    moment = F.timestamp_add("SECOND", -seconds, base).cast("string")
    return F.concat(F.translate(moment, " ", "T"), F.lit("Z"))


def client_rows(numbers: DataFrame, base_ts: str, seed: int = 0) -> DataFrame:
    """A client for each row number in column ``n``."""
    n = F.col("n")
    row = _Row(n, seed)
    cities = _arrays(CITIES)
    picks = numbers.select(
        "n",
        row.one_of(FIRST_NAMES).alias("first_name"),
        row.one_of(LAST_NAMES).alias("last_name"),
        row.between(MAIL_NUMBER).alias("mail"),
        row.below(len(CITIES)).alias("place"),
        row.below(PRIME).alias("city"),
        row.between(AGES).cast("int").alias("age"),
        row.one_of(SEGMENTS).alias("segment"),
        row.between(REGISTERED_DAYS).alias("days"),
    )
    local = _at(cities, F.col("place"))
    name = F.concat(F.col("first_name"), F.lit("."), F.col("last_name"), F.col("mail"))
    return picks.select(
        _id("CLI-", n).alias("client_id"),
        "first_name",
        "last_name",
        F.concat(F.lower(name), F.lit("@example.com")).alias("email"),
        _at(F.array(*(F.lit(c) for c in CITIES)), F.col("place")).alias("country"),
        _at(local, F.col("city") % F.size(local)).alias("city"),
        "age",
        "segment",
        _ago(base_ts, F.col("days") * 86_400).alias("registered_at"),
    )


def product_rows(numbers: DataFrame, seed: int = 0) -> DataFrame:
    """A product for each row number in column ``n``."""
    n = F.col("n")
    row = _Row(n, seed)
    names = tuple(SUB_CATEGORIES)
    picks = numbers.select(
        "n",
        row.below(len(names)).alias("kind"),
        row.below(len(SUB_CATEGORIES[names[0]])).alias("sub"),
        row.one_of(BRANDS).alias("brand"),
        row.between(NAME_NUMBER).alias("number"),
        row.below(PRIME).alias("dear"),
        _cents(row.between(WEIGHT_CENTS)).alias("weight_kg"),
        _cents(row.between(RATING_CENTS)).alias("rating"),
        row.between(STOCK).cast("int").alias("stock"),
    )
    low, high = (
        _at(F.array(*(F.lit(PRICES[c][i] * 100) for c in names)), F.col("kind")) for i in (0, 1)
    )
    sub_category = _at(_at(_arrays(SUB_CATEGORIES), F.col("kind")), F.col("sub"))
    return picks.withColumn("sub_category", sub_category).select(
        _id("PRD-", n).alias("product_id"),
        F.concat_ws(" ", "brand", "sub_category", F.col("number").cast("string")).alias("name"),
        _at(F.array(*(F.lit(c) for c in names)), F.col("kind")).alias("category"),
        "sub_category",
        "brand",
        _cents(low + F.col("dear") % (high - low + 1)).alias("price"),
        "weight_kg",
        "rating",
        "stock",
    )


def transaction_rows(
    numbers: DataFrame, clients: int, products: int, base_ts: str, seed: int = 0
) -> DataFrame:
    """A transaction for each row number in column ``n``.

    It names one of the clients numbered below ``clients`` and one of the products
    numbered below ``products``.
    """
    n = F.col("n")
    row = _Row(n, seed)
    picks = numbers.select(
        "n",
        _id("CLI-", row.number(clients)).alias("client_id"),
        _id("PRD-", row.number(products)).alias("product_id"),
        row.between(QUANTITY).cast("int").alias("quantity"),
        row.between(UNIT_PRICE_CENTS).alias("unit_cents"),
        row.one_of(CURRENCIES).alias("currency"),
        row.one_of(PAYMENT_METHODS).alias("payment_method"),
        row.one_of(STATUSES).alias("status"),
        row.between(RECENT_SECONDS).alias("seconds"),
    )
    return picks.select(
        _id("TXN-", n).alias("transaction_id"),
        "client_id",
        "product_id",
        "quantity",
        _cents(F.col("unit_cents")).alias("unit_price"),
        _cents(F.col("unit_cents") * F.col("quantity")).alias("total_amount"),
        "currency",
        "payment_method",
        "status",
        _ago(base_ts, F.col("seconds")).alias("transaction_time"),
    )


def _numbers(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(count).withColumnRenamed("id", "n")


def synth_clients(spark: SparkSession, n: int, base_ts: str, seed: int = 0) -> DataFrame:
    return client_rows(_numbers(spark, n), base_ts, seed)


def synth_products(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    return product_rows(_numbers(spark, n), seed)


def synth_transactions(
    spark: SparkSession, n: int, clients: int, products: int, base_ts: str, seed: int = 0
) -> DataFrame:
    return transaction_rows(_numbers(spark, n), clients, products, base_ts, seed)
