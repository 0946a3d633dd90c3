SELECT c_nationkey, count(*) AS n_orders, sum(o_totalprice) AS revenue
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
WHERE o_orderdate >= CAST(:since AS DATE)
GROUP BY c_nationkey
