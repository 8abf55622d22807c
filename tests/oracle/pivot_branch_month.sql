SELECT codfilial,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 1 THEN qt END), 0) AS DOUBLE) AS M01,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 2 THEN qt END), 0) AS DOUBLE) AS M02,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 3 THEN qt END), 0) AS DOUBLE) AS M03,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 4 THEN qt END), 0) AS DOUBLE) AS M04,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 5 THEN qt END), 0) AS DOUBLE) AS M05,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 6 THEN qt END), 0) AS DOUBLE) AS M06,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 7 THEN qt END), 0) AS DOUBLE) AS M07,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 8 THEN qt END), 0) AS DOUBLE) AS M08,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 9 THEN qt END), 0) AS DOUBLE) AS M09,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 10 THEN qt END), 0) AS DOUBLE) AS M10,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 11 THEN qt END), 0) AS DOUBLE) AS M11,
       CAST(COALESCE(SUM(CASE WHEN month(dtmov) = 12 THEN qt END), 0) AS DOUBLE) AS M12
FROM pcmov WHERE codoper = 'S' AND year(dtmov) = 2000
GROUP BY codfilial
