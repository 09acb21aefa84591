"""Schemas of the CSV files the jobs read."""

from __future__ import annotations

SALES_RAW = (
    "order_id int, store_id string, product string, category string, quantity int, "
    "price int, sales_amount int, order_date string, city string"
)
SALES = (
    "order_id string, customer_id string, order_date string, city string, category string, "
    "price double, qty double, discount_pct double, payment_method string, order_status string"
)
TRANSACTIONS = (
    "transaction_id int, transaction_time string, transaction_amount double, merchant string, "
    "customer_age int, customer_region string, is_fraud int"
)
CUSTOMERS = (
    "customer_id int, gender string, senior_citizen int, partner string, dependents string, "
    "tenure_months int, phone_service string, internet_service string, contract_type string, "
    "payment_method string, monthly_charges double, total_charges double, avg_monthly_usage double, "
    "complaints int, churn string"
)
RATINGS = "user_id int, product_id int, rating int, timestamp int"
PATIENTS = (
    "patient_id int, age int, bmi double, blood_pressure int, glucose_level int, cholesterol int, disease int"
)
POSTS = (
    "post_id int, post_text string, user_id int, post_time timestamp, likes int, shares int, sentiment string"
)
