SELECT * FROM customer_summary_x
