"""Oracle SQL for the views and the business questions."""

from __future__ import annotations

from .sqltext import ea, ea_when, es, es_when, isum, n_when, on_hb, on_sales, pct, share

Y = "sale_amount"

DASHBOARD = f"""board AS (
  SELECT city_id, store_id, COUNT(DISTINCT dt) AS total_days_recorded, COUNT(*) AS total_hours_recorded,
    {es(Y)} AS total_sales, {isum('sale_flag')} AS hours_with_sales, {isum('high_sales_flag')} AS hours_with_high_sales,
    {ea(Y)} AS avg_sales_per_hour, {isum('stockout_flag')} AS total_stockout_hours,
    {share('sale_flag')} AS engagement_rate, {isum('promo_flag')} AS promo_hours,
    {ea_when('promo_flag = 1', Y)} AS avg_sales_during_promo, {n_when("weather = 'rainy'")} AS rainy_hours,
    {ea_when("weather = 'rainy'", Y)} AS avg_sales_rainy_hours
  FROM hb GROUP BY city_id, store_id)"""

ORACLE = {
    "hourly_business": on_hb("SELECT * FROM hb"),
    "store_dashboard": on_hb("SELECT * FROM board", DASHBOARD),
    "category_intelligence": on_hb(f"""
        SELECT first_category_id, COUNT(DISTINCT store_id) AS stores_count, {es(Y)} AS total_sales,
          {ea(Y)} AS avg_sales_per_record, {ea_when('sale_flag = 1', Y)} AS avg_sales_when_sold,
          ROUND(STDDEV_SAMP({Y}), 6) AS sales_stddev, {n_when('stockout_flag = 1')} AS total_stockout_hours,
          {es_when('stockout_flag = 1', Y)} AS potential_lost_sales, {es_when('promo_flag = 1', Y)} AS promo_sales,
          {es_when("weather = 'rainy'", Y)} AS rainy_day_sales, {es_when('holiday_flag = 1', Y)} AS holiday_sales,
          ROUND({ea(Y)} / NULLIF(STDDEV_SAMP({Y}), 0), 6) AS consistency_index
        FROM hb GROUP BY first_category_id"""),
    "rhythm_patterns": on_hb(f"""
        SELECT day_of_week, month, {ea(Y)} AS avg_sales, {share('sale_flag')} AS activity_rate,
          {isum('high_sales_flag')} AS high_sales_hours, {isum('stockout_flag')} AS total_stockout_hours,
          {share('stockout_flag')} AS stockout_rate, {n_when("weather = 'rainy'")} AS rainy_hours,
          {n_when('promo_flag = 1')} AS promo_hours, {n_when('holiday_flag = 1')} AS holiday_hours,
          {ea(f'({Y} + discount * 10)')} AS operational_pressure_index,
          CASE WHEN {ea(Y)} > 15 THEN 'High Activity' WHEN {ea(Y)} BETWEEN 5 AND 15 THEN 'Medium Activity'
            ELSE 'Low Activity' END AS activity_level
        FROM hb GROUP BY day_of_week, month"""),
    "store_indicators": on_hb(f"""
        SELECT store_id, COUNT(*) AS total_hours, COUNT(DISTINCT product_id) AS unique_products, {es(Y)} AS total_sales,
          {es(Y)} / NULLIF(COUNT(DISTINCT product_id), 0) AS avg_sales_per_product,
          CAST(SUM(stockout_flag) AS DOUBLE) / COUNT(*) AS stockout_rate, {isum('sale_flag')} AS active_hours,
          {es(Y)} / NULLIF(SUM(sale_flag), 0) AS avg_sales_active_hour, {es_when('promo_flag = 1', Y)} AS promo_sales,
          {es_when('promo_flag = 1', Y)} / NULLIF({es(Y)}, 0) AS promo_share
        FROM hb GROUP BY store_id"""),
    "q01_store_city_counts": on_sales(
        "SELECT COUNT(DISTINCT store_id) AS unique_stores, COUNT(DISTINCT city_id) AS unique_cities FROM sales"),
    "q02_date_range": on_sales("SELECT MIN(dt) AS start_date, MAX(dt) AS end_date FROM sales"),
    "q03_product_counts": on_sales("""
        SELECT COUNT(DISTINCT product_id) AS unique_products, COUNT(DISTINCT first_category_id) AS first_categories,
          COUNT(DISTINCT second_category_id) AS second_categories, COUNT(DISTINCT third_category_id) AS third_categories
        FROM sales"""),
    "q04_total_sales": on_sales(f"SELECT {es(Y)} AS total_sales FROM sales"),
    "q05_avg_per_hour": on_sales(f"SELECT {es(Y)} / (COUNT(*) * 24) AS avg_sales_per_hour FROM sales"),
    "q06_zero_nonzero": on_sales(
        f"SELECT {n_when(Y + ' = 0')} AS zero_sales_hours, {n_when(Y + ' > 0')} AS non_zero_sales_hours FROM sales"),
    "q07_sales_by_hour": on_sales(
        f"SELECT CAST(hour(dt) AS INT) AS hour_of_day, {es(Y)} AS total_sales FROM sales GROUP BY 1"),
    "q08_sales_by_dow": on_sales(
        f"SELECT CAST(dayofweek(dt) AS INT) AS day_of_week, {es(Y)} AS total_sales FROM sales GROUP BY 1"),
    "q09_holiday_avg": on_sales(f"SELECT holiday_flag, {ea(Y)} AS avg_sales FROM sales GROUP BY 1"),
    "q10_rain_avg": on_sales(
        f"SELECT CASE WHEN precpt > 0 THEN 'rainy' ELSE 'clear' END AS weather, {ea(Y)} AS avg_sales FROM sales GROUP BY 1"),
    "weekend_promo_city": on_hb(
        f"SELECT city_id, {es(Y)} AS total_sales FROM hb WHERE is_weekend = 1 AND promo_flag = 1 GROUP BY 1"),
    "dashboard_top5": on_hb("""
        SELECT city_id, store_id, total_sales, avg_sales_per_hour FROM board
        ORDER BY total_sales DESC, city_id, store_id LIMIT 5""", DASHBOARD),
    "dashboard_bottom5": on_hb("""
        SELECT city_id, store_id, total_stockout_hours FROM board
        ORDER BY total_stockout_hours DESC, city_id, store_id LIMIT 5""", DASHBOARD),
    "q11_stockout_pct": on_hb(f"SELECT {pct()} AS stockout_percentage FROM hb"),
    "q12_stock_avg": on_hb(f"SELECT stockout_flag, {ea(Y)} AS avg_sales FROM hb GROUP BY 1"),
    "q12_stock_avg_status": on_hb(f"SELECT stock_status_flag, {ea(Y)} AS avg_sales FROM hb GROUP BY 1"),
    "q13_worst_products": on_hb(f"""
        SELECT product_id, {pct()} AS stockout_rate_percentage FROM hb GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "q14_stockout_by_hour": on_hb(
        f"SELECT hour_of_day, {pct()} AS stockout_rate_percentage FROM hb GROUP BY 1"),
    "q15_worst_stores": on_hb(f"""
        SELECT store_id, {pct()} AS stockout_rate_percentage FROM hb GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""),
    "q16_top_stores": on_hb(f"""
        SELECT city_id, store_id, {es(Y)} AS total_sales FROM hb GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"""),
    "q17_city_avg_store": on_hb(f"""
        SELECT city_id, {ea('t')} AS avg_sales_per_store
        FROM (SELECT city_id, store_id, {es(Y)} AS t FROM hb GROUP BY 1, 2) GROUP BY 1"""),
    "q18_high_sales_stockout": on_hb(f"""
        SELECT city_id, store_id, {es(Y)} AS total_sales, {pct()} AS stockout_rate_percentage FROM hb GROUP BY 1, 2
        HAVING SUM({Y}) > 1000 AND CAST(SUM(stockout_flag) AS DOUBLE) / COUNT(*) > 0.2"""),
    "q19_category_sales": on_hb(f"SELECT first_category_id, {es(Y)} AS total_sales FROM hb GROUP BY 1"),
    "q20_product_avg": on_hb(f"SELECT product_id, {ea(Y)} AS avg_hourly_sales FROM hb GROUP BY 1"),
    "q21_discount_avg": on_hb(f"""
        SELECT CASE WHEN discount > 0 THEN 'discounted' ELSE 'regular' END AS price_type, {ea(Y)} AS avg_sales
        FROM hb GROUP BY 1"""),
    "q22_discount_ranges": on_hb(f"""
        SELECT CASE WHEN discount = 0 THEN '0%' WHEN discount BETWEEN 0.01 AND 0.10 THEN '1-10%'
          WHEN discount BETWEEN 0.11 AND 0.20 THEN '11-20%' ELSE '21%+' END AS discount_range, {ea(Y)} AS avg_sales
        FROM hb GROUP BY 1"""),
    "q23_promo_lift": on_hb(f"""
        SELECT first_category_id, {ea_when('promo_flag = 1', Y)} AS avg_sales_during_promo,
          {ea_when('promo_flag = 0', Y)} AS avg_sales_regular,
          {ea_when('promo_flag = 1', Y)} - {ea_when('promo_flag = 0', Y)} AS promo_lift
        FROM hb GROUP BY 1"""),
    "q24_activity_compare": on_hb(f"""
        SELECT activity_flag, {ea(Y)} AS avg_sales, {es(Y)} AS total_sales, COUNT(*) AS total_hours FROM hb GROUP BY 1"""),
    "q25_promo_stockout": on_hb(f"""
        SELECT promo_flag, {ea(Y)} AS avg_sales, COUNT(*) AS hours_count FROM hb
        WHERE sale_flag = 1 AND stock_status_flag = 1 GROUP BY 1"""),
    "q26_potential_pairs": on_hb(f"""
        SELECT store_id, product_id, {ea_when('stockout_flag = 0', Y)} AS avg_sales_when_in_stock,
          {isum('stockout_flag')} AS stockout_hours, COUNT(*) AS total_hours,
          CAST(SUM(stockout_flag) AS DOUBLE) / COUNT(*) AS stockout_rate
        FROM hb GROUP BY 1, 2
        HAVING {ea_when('stockout_flag = 0', Y)} > 5 AND CAST(SUM(stockout_flag) AS DOUBLE) / COUNT(*) > 0.2
        ORDER BY stockout_rate DESC, avg_sales_when_in_stock DESC, store_id, product_id LIMIT 20"""),
    "q27_weather_category": on_hb(f"""
        SELECT first_category_id, CASE WHEN avg_temperature < 10 THEN 'cold' WHEN avg_temperature BETWEEN 10 AND 20 THEN 'mild'
          WHEN avg_temperature BETWEEN 21 AND 30 THEN 'warm' ELSE 'hot' END AS temp_range, weather,
          {ea(Y)} AS avg_sales, {es(Y)} AS total_sales, COUNT(*) AS hours_count
        FROM hb GROUP BY 1, 2, 3"""),
    "q28_peak_hours": on_hb(
        f"SELECT hour_of_day FROM hb GROUP BY 1 ORDER BY {es(Y)} DESC, 1 LIMIT 3"),
    "q28_peak_stockouts": on_hb(f"""
        SELECT hb.product_id, COUNT(*) AS stockout_hours, {isum('stockout_flag')} AS total_stockouts
        FROM hb JOIN peak ON hb.hour_of_day = peak.hour_of_day WHERE stockout_flag = 1
        GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
        f"peak AS (SELECT hour_of_day FROM hb GROUP BY 1 ORDER BY {es(Y)} DESC, 1 LIMIT 3)"),
    "q29_potential_increase": on_hb(f"""
        SELECT ROUND(SUM({Y}), 4) AS actual_sales,
          ROUND(SUM(CASE WHEN stockout_flag = 1 THEN a ELSE {Y} END), 4) AS potential_sales,
          ROUND(SUM(CASE WHEN stockout_flag = 1 THEN a ELSE {Y} END) - SUM({Y}), 4) AS potential_increase
        FROM hb JOIN instock i ON hb.product_id = i.product_id""",
        f"instock AS (SELECT product_id, {ea_when('stockout_flag = 0', Y)} AS a FROM hb GROUP BY 1)"),
    "q30_store_health": on_hb(f"""
        SELECT store_id, total_sales, engagement_rate, stockout_rate, ROUND(sd, 6) AS sales_stddev,
          ROUND(total_sales * CAST(0.5 AS DOUBLE) + engagement_rate * 100 * CAST(0.3 AS DOUBLE)
            - stockout_rate * 100 * CAST(0.1 AS DOUBLE) - sd * CAST(0.1 AS DOUBLE), 6) AS store_health_score
        FROM (SELECT store_id, {es(Y)} AS total_sales, {share('sale_flag')} AS engagement_rate,
                CAST(SUM(stockout_flag) AS DOUBLE) / COUNT(*) AS stockout_rate, STDDEV_SAMP({Y}) AS sd
              FROM hb GROUP BY 1)
        ORDER BY store_health_score DESC NULLS LAST, store_id LIMIT 20"""),
}
