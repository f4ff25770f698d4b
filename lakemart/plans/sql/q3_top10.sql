-- One struct as the key: the partial sums are shuffled past the join, which lets
-- adaptive execution split the join of an order with very many lines.
WITH summed AS (
  SELECT struct(l_orderkey, o_orderdate, o_shippriority) AS key,
         sum(l_extendedprice * (1 - l_discount))         AS revenue
  FROM {orders}
  JOIN {customer} ON o_custkey = c_custkey
  JOIN {lineitem} ON o_orderkey = l_orderkey
  WHERE c_mktsegment = :segment AND o_orderdate < :cutoff AND l_shipdate > :cutoff
  GROUP BY struct(l_orderkey, o_orderdate, o_shippriority)
)
SELECT key.l_orderkey     AS orderkey,
       revenue,
       key.o_orderdate    AS orderdate,
       key.o_shippriority AS shippriority
FROM summed
ORDER BY revenue DESC, orderdate, orderkey
LIMIT :top
