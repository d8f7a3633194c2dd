"""Hand-made customer rows for tests."""

from __future__ import annotations

from modelwatch.schema import CUSTOMER_SPEC, INTERNET_ADDONS, PAYMENTS

# Fixed value: column order in the files.
COLUMNS = [
    "customerID",
    "gender",
    "SeniorCitizen",
    "Partner",
    "Dependents",
    "tenure",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    *INTERNET_ADDONS,
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
    "MonthlyCharges",
    "TotalCharges",
    "Churn",
]


def customer(i: int, **changes) -> dict:
    net = ("DSL", "Fiber optic", "No")[i % 3]
    phone = "No" if i % 10 == 0 else "Yes"
    row = {
        "customerID": f"{i:04d}-ABCDE",
        "gender": ("Male", "Female")[i % 2],
        "SeniorCitizen": str(int(i % 6 == 0)),
        "Partner": ("Yes", "No")[i % 2],
        "Dependents": ("Yes", "No")[(i // 2) % 2],
        "tenure": str(i % 73),
        "PhoneService": phone,
        "MultipleLines": "No phone service" if phone == "No" else ("Yes", "No")[(i // 3) % 2],
        "InternetService": net,
        "Contract": ("Month-to-month", "One year", "Two year")[(i // 4) % 3],
        "PaperlessBilling": ("Yes", "No")[(i // 5) % 2],
        "PaymentMethod": PAYMENTS[i % 4],
        "MonthlyCharges": f"{20 + (i * 7) % 90}.5",
        "TotalCharges": " " if i % 73 == 0 else f"{(20 + (i * 7) % 90) * (i % 73)}.25",
        "Churn": "Yes" if (i * 13) % 11 < 3 else "No",
    }
    for n, c in enumerate(INTERNET_ADDONS):
        row[c] = "No internet service" if net == "No" else ("Yes", "No")[(i + n) % 2]
    row.update(changes)
    return row


def landed(spark, rows: list[dict], columns: list[str] | None = None):
    columns = columns or COLUMNS
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


assert sorted(COLUMNS) == sorted(CUSTOMER_SPEC.columns)
