SELECT year(created_at) AS year,
       month(created_at) AS month,
       count(*) AS total_orders,
       sum(total_amount) AS hope_total_revenue,
       count_if(order_status = 'DELIVERED') AS delivered_orders,
       count_if(order_status = 'CANCELLED') AS cancelled_orders
FROM {orders}
GROUP BY ALL
ORDER BY year, month
