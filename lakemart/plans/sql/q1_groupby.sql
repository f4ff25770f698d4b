SELECT l_returnflag,
       l_linestatus,
       sum(l_quantity)      AS sum_qty,
       sum(l_extendedprice) AS sum_base_price,
       avg(l_discount)      AS avg_disc,
       count(*)             AS count_order
FROM {lineitem}
GROUP BY l_returnflag, l_linestatus
ORDER BY l_returnflag, l_linestatus
