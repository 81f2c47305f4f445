"""Declared schemas of the fifteen source tables (as DDL), and the keys and rules they carry."""

from __future__ import annotations

# Column names and types of the source tables
SCHEMAS: dict[str, str] = {
    "customers": (
        "customer_id string, email string, first_name string, last_name string, date_of_birth date, "
        "gender string, city string, state string, country string, postal_code string, "
        "income_bracket string, registration_date timestamp_ntz, last_login_date timestamp_ntz, "
        "is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "customer_demographics": (
        "customer_id string, age_group string, education_level string, occupation string, "
        "household_size int, marital_status string, interests string, lifestyle_segment string, "
        "created_at timestamp_ntz"
    ),
    "transactions": (
        "transaction_id string, customer_id string, order_date timestamp_ntz, total_amount decimal(10,2), "
        "currency string, payment_method string, shipping_address string, order_status string, "
        "created_at timestamp_ntz"
    ),
    "transaction_items": (
        "item_id string, transaction_id string, product_id string, product_name string, category string, "
        "subcategory string, quantity int, unit_price decimal(10,2), total_price decimal(10,2), "
        "created_at timestamp_ntz"
    ),
    "customer_segments": (
        "segment_id string, segment_name string, segment_description string, criteria string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "customer_segment_mapping": (
        "mapping_id string, customer_id string, segment_id string, assigned_date timestamp_ntz, "
        "confidence_score decimal(3,2), created_at timestamp_ntz"
    ),
    "campaigns": (
        "campaign_id string, campaign_name string, campaign_type string, channel string, "
        "target_audience string, start_date date, end_date date, budget decimal(12,2), status string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "campaign_performance": (
        "performance_id string, campaign_id string, date date, impressions int, clicks int, "
        "conversions int, revenue decimal(10,2), ctr decimal(5,4), conversion_rate decimal(5,4), "
        "roas decimal(5,2), created_at timestamp_ntz"
    ),
    "ab_tests": (
        "test_id string, test_name string, campaign_id string, variant_a_description string, "
        "variant_b_description string, start_date date, end_date date, sample_size int, "
        "test_status string, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "ab_test_results": (
        "result_id string, test_id string, variant string, impressions int, clicks int, "
        "conversions int, revenue decimal(10,2), ctr decimal(5,4), conversion_rate decimal(5,4), "
        "created_at timestamp_ntz"
    ),
    "sessions": (
        "session_id string, customer_id string, session_start timestamp_ntz, session_end timestamp_ntz, "
        "duration_seconds int, device_type string, browser string, operating_system string, "
        "ip_address string, user_agent string, referrer string, utm_source string, utm_medium string, "
        "utm_campaign string, created_at timestamp_ntz"
    ),
    "page_views": (
        "view_id string, session_id string, customer_id string, page_url string, page_title string, "
        "page_category string, timestamp timestamp_ntz, time_on_page int, scroll_depth int, "
        "referrer_page string, created_at timestamp_ntz"
    ),
    # event_data and interaction_data hold one JSON object whose shape depends on the type
    "events": (
        "event_id string, session_id string, customer_id string, event_type string, event_name string, "
        "event_data string, timestamp timestamp_ntz, created_at timestamp_ntz"
    ),
    "product_interactions": (
        "interaction_id string, session_id string, customer_id string, product_id string, "
        "interaction_type string, timestamp timestamp_ntz, interaction_data string, created_at timestamp_ntz"
    ),
    "search_queries": (
        "query_id string, session_id string, customer_id string, search_term string, "
        "search_results_count int, clicked_result_position int, timestamp timestamp_ntz, "
        "created_at timestamp_ntz"
    ),
}

# Primary and unique keys
PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "customer_demographics": ["customer_id"],
    "transactions": ["transaction_id"],
    "transaction_items": ["item_id"],
    "customer_segments": ["segment_id"],
    "customer_segment_mapping": ["mapping_id"],
    "campaigns": ["campaign_id"],
    "campaign_performance": ["performance_id"],
    "ab_tests": ["test_id"],
    "ab_test_results": ["result_id"],
    "sessions": ["session_id"],
    "page_views": ["view_id"],
    "events": ["event_id"],
    "product_interactions": ["interaction_id"],
    "search_queries": ["query_id"],
}
UNIQUE_KEYS = {
    "customers": [["email"]],
    "customer_segments": [["segment_name"]],
    "customer_segment_mapping": [["customer_id", "segment_id"]],
}

# Columns that must be present
REQUIRED = {
    "customers": ["customer_id", "email"],
    "customer_segments": ["segment_id", "segment_name"],
    "campaigns": ["campaign_id", "campaign_name"],
    "ab_tests": ["test_id", "test_name"],
    "sessions": ["session_id", "customer_id", "session_start"],
    "page_views": ["view_id", "session_id", "page_url", "timestamp"],
    "events": ["event_id", "session_id", "event_type", "timestamp"],
    "product_interactions": ["interaction_id", "session_id", "product_id", "interaction_type", "timestamp"],
    "search_queries": ["query_id", "session_id", "search_term", "timestamp"],
}

# Child table, key, parent table, what a deleted parent does to its children
FOREIGN_KEYS = [
    ("customer_demographics", "customer_id", "customers", "cascade"),
    ("transactions", "customer_id", "customers", "set_null"),
    ("transaction_items", "transaction_id", "transactions", "cascade"),
    ("customer_segment_mapping", "customer_id", "customers", "cascade"),
    ("customer_segment_mapping", "segment_id", "customer_segments", "cascade"),
    ("campaign_performance", "campaign_id", "campaigns", "cascade"),
    ("ab_tests", "campaign_id", "campaigns", "set_null"),
    ("ab_test_results", "test_id", "ab_tests", "cascade"),
]

# Allowed values of enumerated columns
DOMAINS = {
    ("customers", "gender"): ["M", "F", "O"],
    ("transactions", "order_status"): ["Pending", "Processing", "Shipped", "Delivered", "Cancelled", "Refunded"],
    ("ab_test_results", "variant"): ["A", "B"],
}

# Column defaults
DEFAULTS = {
    "customers": {"is_active": True},
    "transactions": {"currency": "USD"},
    "campaigns": {"status": "Active"},
    "ab_tests": {"test_status": "Running"},
}
