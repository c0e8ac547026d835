"""Record schemas of the inputs, as Spark DDL text."""

VISIT_ACTION = (
    "date_part STRING, user_id STRING, session_id STRING, page_id STRING, action_time STRING, "
    "search_keyword STRING, click_category_id STRING, click_product_id STRING, "
    "order_category_ids STRING, order_product_ids STRING, pay_category_ids STRING, "
    "pay_product_ids STRING, city_id STRING"
)
PRODUCT_INFO = "product_id STRING, product_name STRING, extend_info STRING"
CITY_INFO = "city_id INT, city_name STRING, area STRING"
TASK = "task_id INT, task_param STRING"
RATING = "user_id INT, movie_id INT, rating DOUBLE, rated_at BIGINT"
ORDER_JSON = "orderId STRING, provinceId INT, orderPrice DOUBLE"
TYPED_ORDER_JSON = "orderType STRING, orderId STRING, provinceId INT, orderPrice DOUBLE"
EMPLOYEE = (
    "empno INT, ename STRING, job STRING, mgr INT, hiredate STRING, sal DOUBLE, comm DOUBLE, deptno INT"
)
NEWS = (
    "id INT, title STRING, url STRING, publisher STRING, category STRING, story STRING, "
    "hostname STRING, timestamp STRING"
)
CELL = "rowkey STRING, family STRING, qualifier STRING, value STRING"
TOPIC_MESSAGE = "r STRING, f STRING, q ARRAY<STRING>, v ARRAY<STRING>"
