"""Input schemas. Every field may be null: inputs are dirty, and operators drop rows lacking their keys."""

CUSTOMERS = (
    "customer_id string, first_name string, last_name string, birth_date date, email string, "
    "phone_number string, address string, city string, fidelity_card string, customer_type string"
)
PRODUCTS = (
    "product_id string, product_name string, category string, tva_rate double, base_price double, "
    "age_restricted string"
)
PRICES = "price_id string, product_id string, valid_date date, price double"
DISCOUNTS = "discount_id string, product_id string, discount_percentage double, valid_from date, valid_to date"
TRANSACTIONS = (
    "transaction_id string, customer_id string, product_id string, quantity int, "
    "transaction_date timestamp, payment_method string, store_id string, unit_price_at_purchase double"
)

SALES = (
    "transaction_id string, client_id int, transaction_date timestamp, amount double, merchant string, "
    "category string"
)
ACCOUNTS = (
    "account_id string, client_id int, account_type string, opening_balance double, open_date timestamp"
)
LOANS = (
    "loan_id string, client_id int, principal_amount double, interest_rate double, start_date timestamp, "
    "term_months int, loan_type string"
)
DELAY_FEES = (
    "fee_id string, client_id int, loan_id string, fee_amount double, fee_date timestamp, days_delayed int"
)

ORDER_STREAM = "order_id string, quantity int, type string, date timestamp"
TRANSACTION_STREAM = "transaction_id string, client_id string, amount double, timestamp timestamp"
CLIENT_STREAM = "client_id string, client_name string, account_type string, updated_at timestamp"

USERS = "user_id long, country string, signup_date date"
USER_EVENTS = "event_id long, user_id long, event_time timestamp, event_type string, page_url string"
VISITS = "user_id long, page string, ts timestamp"
USER_SALES = "user_id long, item string, price double, quantity int"
LATENCY_EVENTS = "dataset string, dataproduct string, mandant string, refdate string, timestamp string"
