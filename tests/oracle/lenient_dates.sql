WITH t AS (
  SELECT numverba, dtcadastro,
         CASE WHEN numverba % 7 = 0 THEN '31/02/' || CAST(year(dtcadastro) AS VARCHAR)
              WHEN numverba % 2 = 0 THEN strftime(dtcadastro, '%d/%m/%Y')
              ELSE strftime(dtcadastro, '%Y-%m-%d') END AS texto
  FROM pcverba)
SELECT numverba, texto,
       CAST(COALESCE(try_strptime(texto, '%d/%m/%Y'), try_strptime(texto, '%Y-%m-%d')) AS DATE) AS data
FROM t
