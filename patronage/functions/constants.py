"""Thresholds, names, lists and formats that results depend on.

They are given by the analyses themselves, so they are stated here as plain text,
in their natural order.
"""

# Order statuses that count as a sale
SUCCESSFUL_STATUSES = ("Delivered", "Shipped")

# RFM score bounds
RECENCY_STEPS = [(30, 5), (60, 4), (90, 3), (180, 2)]
FREQUENCY_STEPS = [(10, 5), (7, 4), (4, 3), (2, 2)]
MONETARY_STEPS = [(5000, 5), (3000, 4), (1500, 3), (500, 2)]
RFM_SEGMENT_STEPS = [(500, "Champions"), (400, "Loyal"), (300, "At Risk"), (200, "Can't Lose"), (100, "New")]
RFM_SEGMENT_DEFAULT = "Promising"
VALUE_TIER_STEPS = [(5000, "Premium"), (2000, "High"), (1000, "Medium"), (500, "Low")]
VALUE_TIER_DEFAULT = "Minimal"
# (minimum orders, maximum recency in days, label)
ENGAGEMENT_STEPS = [
    (8, 60, "Highly Engaged"),
    (5, 90, "Engaged"),
    (3, 180, "Moderately Engaged"),
    (1, 365, "Low Engagement"),
]
ENGAGEMENT_DEFAULT = "Inactive"
LIFETIME_VALUE_FACTOR = "1.25"

# Campaign bounds on return on ad spend
PERFORMANCE_STEPS = [(3.0, "High"), (2.0, "Medium"), (1.0, "Low")]
EFFICIENCY_STEPS = [(5.0, 100), (3.0, 80), (2.0, 60), (1.5, 40), (1.0, 20)]
ROAS_CAP = 999.99

# A/B evidence by impressions of both variants
SIGNIFICANCE_STEPS = [(1000, "Yes"), (500, "Maybe")]
CONFIDENCE_STEPS = [(2000, "99%"), (1000, "95%"), (500, "90%")]
P_VALUE_STEPS = [(2000, 0.01), (1000, 0.05), (500, 0.10)]
MIN_SAMPLE_SIZE = 2000

# RFM segment to target audience
SEGMENT_AUDIENCE = {
    "Champions": "High Value",
    "Loyal": "Existing Customers",
    "At Risk": "At Risk",
    "Can't Lose": "High Value",
    "New": "New Customers",
    "Promising": "New Customers",
}

# RFM segment to campaign type
SEGMENT_CAMPAIGN_TYPE = {
    "Champions": "Email",
    "Loyal": "Social Media",
    "At Risk": "Display",
    "Can't Lose": "Email",
    "New": "Search",
    "Promising": "Social Media",
}

# K-means segment names of the five-cluster model
KMEANS_SEGMENT_NAMES = {0: "Low Value", 1: "Medium Value", 2: "High Value", 3: "Premium", 4: "VIP"}

# Typical page sequence per journey type
JOURNEY_PATHS = {
    "purchase": ["Home", "Products", "Product Detail", "Cart", "Checkout"],
    "browse": ["Home", "Categories", "Product List", "Product Detail"],
    "search": ["Home", "Search", "Search Results", "Product Detail"],
}
JOURNEY_PATH_DEFAULT = ["Home", "Products"]
CAMPAIGN_PLAN_CHANNELS = ["Email", "Social Media", "Search"]

# Score bins (edges, labels)
SUCCESS_BINS = ([0, 0.3, 0.6, 0.8, 1.0], ["Low", "Medium", "High", "Very High"])
BUDGET_BINS = ([0, 100, 500, 1000, float("inf")], ["Low", "Medium", "High", "Premium"])
ROI_BINS = ([0, 50, 100, 200, float("inf")], ["Low", "Medium", "High", "Premium"])
STAGE_BINS = ([0, 0.5, 0.7, 0.9, 1.0], ["Low", "Medium", "High", "Very High"])
CONVERSION_BINS = ([0, 0.2, 0.4, 0.6, 0.8, 1.0], ["Very Low", "Low", "Medium", "High", "Very High"])
STAGE_BINS_COARSE = ([0, 0.5, 0.8, 1.0], ["Low", "Medium", "High"])
PROBABILITY_BINS_COARSE = ([0, 0.3, 0.7, 1.0], ["Low", "Medium", "High"])
FIVE_LEVELS = ["Very Low", "Low", "Medium", "High", "Very High"]

# Feature lists of the segmentation model (each feature once)
SEGMENTATION_FEATURES = [
    "recency_days", "frequency", "monetary_value",
    "recency_score", "frequency_score", "monetary_score",
    "rfm_score", "customer_lifetime_value",
    "total_sessions", "avg_session_duration", "total_page_views",
    "purchase_events", "add_to_cart_events", "total_search_queries",
    "product_views", "unique_products_viewed",
    "engagement_score", "cart_behavior",
    "session_intensity", "conversion_efficiency",
    "purchase_velocity", "engagement_score_normalized",
    "search_intensity", "product_exploration",
    "rfm_composite",
    "value_engagement_ratio", "churn_risk",
    "upsell_potential", "lifetime_value_potential",
    "is_high_value", "is_engaged", "is_mobile_user", "is_return_visitor",
]

# Measures of a segment profile
SEGMENT_MEASURES = [
    "monetary_value", "frequency", "recency_days", "engagement_score",
    "customer_lifetime_value", "churn_risk", "upsell_potential",
]
RADAR_MEASURES = [
    "monetary_value", "frequency", "engagement_score", "customer_lifetime_value", "purchase_velocity",
]

# Order-history features shared by the second variant of every model family
ORDER_HISTORY_FEATURES = [
    "recency_days", "frequency", "monetary_value",
    "avg_order_value", "total_orders", "days_since_first_order",
    "customer_lifetime_value", "avg_days_between_orders",
    "order_count_30d", "order_count_90d", "order_count_365d",
    "revenue_30d", "revenue_90d", "revenue_365d",
]

# Feature lists of the forecasting models
REVENUE_FEATURES = [
    "rfm_score", "frequency", "avg_order_value", "days_since_last_purchase",
    "day_of_week", "month", "quarter", "year",
    "revenue_lag_1", "revenue_lag_7", "revenue_lag_30",
    "revenue_ma_7", "revenue_ma_30",
    "customer_age_days",
]
CTR_FEATURES = [
    "rfm_score", "frequency", "avg_order_value",
    "day_of_week", "month", "quarter", "year",
    "ctr_lag_1", "ctr_ma_7",
    "customer_age_days",
]

# Feature list of both journey models
JOURNEY_FEATURES = [
    "rfm_score", "frequency", "avg_order_value", "days_since_last_purchase",
    "total_sessions", "total_page_views", "total_events", "total_interactions",
    "product_views", "cart_adds", "customer_age_days",
    "avg_session_duration", "engagement_score",
    "purchase_velocity", "session_intensity",
    "conversion_efficiency", "search_intensity", "product_exploration",
]

# Feature lists of the campaign models
SUCCESS_FEATURES = [
    "recency_days", "frequency", "monetary_value",
    "avg_order_value", "customer_lifetime_value",
    "campaign_count", "avg_roas", "avg_ctr", "total_campaign_revenue",
    "campaign_response_rate", "avg_ctr_lift", "rfm_score",
    "total_sessions", "total_events",
    "conversion_probability", "churn_risk", "upsell_potential",
]
BUDGET_FEATURES = [
    "recency_days", "frequency", "monetary_value",
    "avg_order_value", "customer_lifetime_value",
    "campaign_count", "avg_roas", "total_campaign_revenue",
    "rfm_score", "conversion_probability",
]

# Rule segments (id, name, description, criteria as JSON)
RULE_SEGMENTS = [
    ("SEG_001", "High Value Customers", "Customers with high RFM scores and significant purchase history",
     '{"rfm_score": "5", "monetary_value": ">1000"}'),
    ("SEG_002", "Loyal Customers", "Customers with high frequency and recent purchases",
     '{"frequency": ">10", "recency_days": "<30"}'),
    ("SEG_003", "At Risk Customers", "Customers with declining engagement or no recent purchases",
     '{"recency_days": ">90", "frequency": "<3"}'),
    ("SEG_004", "New Customers", "Recently acquired customers with potential for growth",
     '{"registration_date": ">30 days ago", "frequency": "<5"}'),
    ("SEG_005", "Churned Customers", "Customers who have stopped engaging",
     '{"recency_days": ">180", "is_active": false}'),
]

# Name parts that place a column in a feature category of the dataset profile
FEATURE_CATEGORY_PARTS = {
    "rfm_features": (["rfm"], ["recency_days", "frequency", "monetary_value"]),
    "demographic_features": ([], [
        "age_group", "education_level", "occupation", "household_size",
        "marital_status", "interests", "lifestyle_segment",
    ]),
    "journey_features": (["session", "page", "engagement", "conversion", "search", "product"], []),
    "campaign_features": (["campaign", "ctr", "roas", "conversion", "ab_test"], []),
    "engineered_features": (["velocity", "intensity", "efficiency", "potential", "risk", "ratio"], []),
}
