"""Names, labels, bounds and markers that results depend on."""

# Metric keys and the dashboard labels that select them.
METRIC_LABELS = {
    "turnover": "Денежный оборот",
    "net_revenue": "Чистый доход",
    "orders": "Кол-во заказов",
    "customers": "Кол-во клиентов",
    "aov": "Средний чек (AOV)",
    "arpu": "Средний доход (ARPU)",
}

# Period keys and the dashboard labels that select them.
PERIOD_LABELS = {
    "last_month": "За последний месяц",
    "last_quarter": "За последний квартал",
    "last_year": "За последний год",
}

# Calendar months each period reaches back.
PERIOD_MONTHS = {"last_month": 1, "last_quarter": 3, "last_year": 12}

# Order states left out of sales measures, and the completed state.
INACTIVE_STATUSES = ("canceled", "unavailable")
DELIVERED_STATUS = "delivered"

# Exclusive upper bound in days and label of each delivery bucket.
DELIVERY_BUCKETS = (
    (0, "Меньше дня"),
    (3, "0-3 дня"),
    (7, "4-7 дней"),
    (14, "8-14 дней"),
    (30, "14-30 дней"),
    (60, "1-2 месяца"),
    (90, "2-3 месяца"),
)
DELIVERY_BUCKET_BEYOND = "Больше 3 месяцев"

# Inclusive cumulative percent that ends class A and class B.
ABC_A_UNTIL = 80
ABC_B_UNTIL = 95

# Days after which an order is late, and a route is a problem.
LATE_DAYS = 14
PROBLEM_ROUTE_DAYS = 90

# CSV texts read as missing, as pandas.read_csv does by default.
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
