"""Schemas of the input and result tables (DDL strings)."""

ACTION = (
    "date date, user_id bigint, session_id string, page_id bigint, action_time timestamp, "
    "search_keyword string, click_category_id bigint, click_product_id bigint, "
    "order_category_ids string, order_product_ids string, "
    "pay_category_ids string, pay_product_ids string, city_id bigint"
)
# The same table as delivered in text form: dates and times are strings.
ACTION_TEXT = ACTION.replace("date date", "date string").replace("action_time timestamp", "action_time string")
USER_INFO = (
    "user_id bigint, username string, name string, age int, professional string, city string, sex string"
)
PRODUCT_INFO = "product_id bigint, product_name string, extend_info string"
CITY_INFO = "city_id bigint, city_name string, area string"
TASK = (
    "task_id bigint, task_name string, create_time string, start_time string, finish_time string, "
    "task_type string, task_status string, task_param string"
)
AD_BLACKLIST = "user_id bigint"
AD_CLICK = "click_time timestamp, date date, province string, city string, user_id bigint, ad_id bigint"
AD_USER_CLICK_COUNT = "date date, user_id bigint, ad_id bigint, click_count bigint"
AD_STAT = "date date, province string, city string, ad_id bigint, click_count bigint"
AD_PROVINCE_TOP3 = "date date, province string, ad_id bigint, click_count bigint"
AD_CLICK_TREND = "date date, hour string, minute string, ad_id bigint, click_count bigint"

# Action columns kept in session_detail, in table order.
SESSION_DETAIL_COLUMNS = [
    "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id",
    "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids",
]
