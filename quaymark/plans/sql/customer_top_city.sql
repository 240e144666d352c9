SELECT city, count(*) AS total_customer
FROM {customers}
GROUP BY city
ORDER BY total_customer DESC, city
