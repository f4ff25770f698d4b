WITH per_order AS (
  SELECT l_orderkey,
         sum(l_extendedprice * (1 - l_discount)) AS revenue,
         sum(l_quantity)                         AS quantity
  FROM {lineitem}
  GROUP BY l_orderkey
),
located AS (
  SELECT c_custkey, n_name, r_name
  FROM {customer}
  JOIN {nation} ON c_nationkey = n_nationkey
  JOIN {region} ON n_regionkey = r_regionkey
)
SELECT r_name AS region_name,
       n_name AS nation_name,
       o_orderdate,
       o_orderstatus,
       sum(revenue)                           AS total_revenue,
       CAST(sum(quantity) AS DECIMAL(25, 2))  AS total_quantity,
       count(DISTINCT o_orderkey)             AS order_count
FROM {orders}
JOIN located ON o_custkey = c_custkey
JOIN per_order ON o_orderkey = l_orderkey
GROUP BY ALL
