SELECT sum(l_extendedprice * l_discount) AS revenue
FROM {lineitem}
WHERE l_shipdate >= :start
  AND l_shipdate < :end
  AND l_discount BETWEEN :low AND :high
  AND l_quantity < :quantity
